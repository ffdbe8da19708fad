from collections import defaultdict

import pytest
from tests.conftest import SMALL
from tests.llm.brute import DOCUMENT, documents, words

from pyspark.sql import functions as F
from risklake.llm import mixing
from risklake.llm.mixing import mixed_documents, mixed_sizes, op8_mix_sources


def targets(sizes, weights=(5, 2, 1), most=3):
    """Share all words by weight, stop sources at their cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        rest, heavy = total - sum(stopped.values()), sum(weight[s] for s in open_)
        share = {s: rest * weight[s] / heavy for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return stopped | share
        stopped |= {s: float(most * sizes[s]) for s in over}


def checked(docs, got):
    sizes = defaultdict(int)
    largest = defaultdict(int)
    for d in docs:
        n = len(words(d.text))
        sizes[d.source] += n
        largest[d.source] = max(largest[d.source], n)
    wanted = targets(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0)
    by = defaultdict(list)
    for d in docs:
        by[(d.doc_id, len(words(d.text)))].append(d.source)
    for r in got:
        sources = by[(r.doc_id, r.size)]
        source = next(s for s in sources if sizes[s] == r.source_size)
        assert r.target == pytest.approx(wanted[source])
        sources.remove(source)
        taken[source] += r.taken
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= largest[s]


def test_query(spark):
    got = op8_mix_sources(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    checked(docs, got)
    again = op8_mix_sources(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_many_levels_keep_each_source_near_its_target(spark):
    rows = [(i, "w " * (1 + i * 7919 % 23), "en", f"s{min(i % 5, 1)}", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCUMENT)
    got = mixed_sizes(df, fan_in=4).collect()
    checked(rows and df.collect(), got)
    assert len({r.taken / r.size for r in got}) > 1


def test_chance_is_the_fraction(spark):
    """Over many seeds an item is taken as often as its source's ratio says."""
    df = spark.createDataFrame([(i, "w " * (i + 1), "en", s, 0) for i in range(6) for s in "ab"], DOCUMENT)
    total, runs = 0, 24
    for seed in range(runs):
        total += sum(r.taken / r.size for r in mixed_sizes(df, seed=seed).collect() if r.target > r.source_size)
    ratio = 2 * 5 / 7
    assert total / runs / 6 == pytest.approx(ratio, abs=0.12)


def test_nulls_repeats_and_empty(spark):
    texts = [None, "", "  \t", "a b c", "a b c", "a b c", "d " * 50, "e", "f g", None]
    df = documents(spark, texts, [1, 2, 3, 4, 4, 4, None, None, 5, None])
    df = df.withColumn("source", F.when(F.col("doc_id") == 5, None).otherwise(F.col("source"))).withColumn("size", F.lit("clash"))
    got = mixed_sizes(df).collect()
    assert len(got) == len(texts)
    checked(df.collect(), got)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mixed_sizes(df.limit(0)).count() == 0
    assert {r.target for r in mixed_sizes(df.filter("text IS NULL")).collect()} == {0.0}


def test_documents_come_as_often_as_taken(spark):
    texts = ["a b c", "a b c", "d " * 40, "x y", None, "long " * 3000]
    df = documents(spark, texts, [1, 1, 2, None, 3, 4]).withColumn("copies", F.lit("clash"))
    rows = mixed_documents(df)
    assert rows.columns == df.columns
    assert sum(len(words(r.text)) for r in rows.collect()) == sum(r.taken for r in mixed_sizes(df).collect())
    assert mixed_documents(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op8_mix_sources(spark, SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_equal_rows_leave_in_many_partitions(spark, monkeypatch):
    """A third of all rows agree in everything, another third in id, source and size only."""
    monkeypatch.setattr(mixing, "REPEATS", 16)
    monkeypatch.setattr(mixing, "NUMBERED", 8)
    texts = ["a b c"] * 400 + [f"x{i} y z" for i in range(400)] + ["d " * (1 + i % 9) for i in range(400)]
    df = documents(spark, texts, [None] * 400 + [7] * 400 + list(range(100, 500))).withColumn("source", F.lit("s"))
    df = df.withColumn("source", F.when(F.col("doc_id") > 200, "t").otherwise("s"))
    sizes = mixed_sizes(df)
    got = sizes.collect()
    assert len(got) == 1200
    checked(df.collect(), got)
    held = sizes.filter("doc_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) > 1 and max(r["count"] for r in held) < 400
    rows = [tuple(r) for r in mixed_documents(df).collect()]
    again = [tuple(r) for r in mixed_documents(df.orderBy(F.rand(3)).repartition(5)).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    taken = defaultdict(int)
    for r in got:
        taken[r.doc_id] += r.taken
    words_of = defaultdict(int)
    for r in mixed_documents(df).collect():
        words_of[r.doc_id] += len(words(r.text))
    assert {k: v for k, v in taken.items() if v} == dict(words_of)
    times = defaultdict(int)
    for r in mixed_documents(df).filter("doc_id = 7").collect():
        times[r.text] += 1
    assert max(times.values()) - min([*times.values(), 9]) <= 1
