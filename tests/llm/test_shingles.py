import random
from fractions import Fraction

from tests.llm.brute import documents, shingles, similar

from pyspark.sql import functions as F
from risklake.llm.components import components
from risklake.llm.shingles import one_of_each, similar_groups
from risklake.llm.sketch import marks


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        body = list(base)
        for _ in range(rng.randint(0, edits)):
            body[rng.randrange(len(body))] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(body))
    return out


def corpus(seed):
    rng = random.Random(seed)
    line = [f"l{i}" for i in range(30)]
    texts = []
    for k in range(4):
        texts += family(rng, [f"f{k}w{rng.randint(0, 300)}" for _ in range(80)], 12, 5)
    texts += [" ".join([f"o{rng.randint(0, 50)}" for _ in range(rng.randint(0, 12))] + line) for _ in range(20)]
    texts += [" ".join(f"v{rng.randint(0, 2)}" for _ in range(rng.randint(0, 9))) for _ in range(40)]
    texts += [texts[0], texts[0].upper(), None, "", " \n", "One", "one", "one two", "One  TWO\t", "Él él É", "q " * 4000]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return texts, ids


def test_against_brute_force(spark):
    for seed, n, share in ((1, 4, Fraction(85, 100)), (2, 5, Fraction(4, 5))):
        texts, ids = corpus(seed)
        df = documents(spark, texts, ids).withColumn("component_id", F.lit("clash"))
        got = sorted(tuple(r) for r in similar_groups(df, n, share).collect())
        assert got == sorted(similar(texts, ids, n, share.numerator, share.denominator))


def test_shared_ids_null_ids_and_empty_table(spark):
    texts = ["a b c d e f", "x y z u v w", "a b c d e f", "a b c d e f", None, "k l m n"]
    ids = [7, 7, 3, None, None, None]
    got = sorted((tuple(r) for r in similar_groups(documents(spark, texts, ids), 4).collect()), key=str)
    assert got == sorted(similar(texts, ids, 4, 4, 5), key=str)
    assert similar_groups(documents(spark, texts, ids).limit(0), 4).count() == 0


def test_one_of_each(spark):
    texts, ids = corpus(3)
    texts, ids = texts + [texts[5], texts[5], None], ids + [ids[5], ids[5], None]
    left = one_of_each(documents(spark, texts, ids)).collect()
    of = {i: c for i, _, c in similar(texts, ids, 5, 4, 5)}
    wanted = sorted(i for i, c in of.items() if i is not None and i == c)
    bare = [i for i, t in zip(ids, texts, strict=True) if not shingles(t, 5)]
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == wanted
    assert sum(r.doc_id is None for r in left) == sum(i is None for i in bare)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 60)] + [(5, 5), (2, 1)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 60)}


def test_sent_sketches_are_given_up(spark, monkeypatch):
    """The order is sent once, marks once a round; the driver holds none of them afterwards."""
    sent, send = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(send(self, value)) or sent[-1])
    texts = [" ".join(f"w{i % 3}x{j}" for j in range(30)) for i in range(9)]
    found = similar_groups(documents(spark, texts)).collect()
    assert {r.component_id for r in found} == {0, 1, 2}
    assert len(sent) == 3 and not any(b._jbroadcast.isValid() for b in sent)


def test_a_sketch_comes_in_few_jobs(spark):
    """Not one for every partition of its shuffle; the counts are all there."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("few-jobs", "")
    found = marks(spark.range(5000).select(F.xxhash64("id").alias("h")), "h", 1 << 20)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for k, v in before.items():
        spark.conf.set(k, v)
    assert found.cells.sum() == 5000 and len(jobs) < 10


def test_whole_texts_are_not_sorted_to_drop_copies(spark):
    """The last join hashes ids and tags; rows that repeat an id and text are met apart, only if there are any."""
    text = " ".join(f"w{i}" for i in range(40))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unique = one_of_each(documents(spark, [text, text + " end", "other words here", ""]))
        repeated = one_of_each(documents(spark, [text, text, "other words here", ""], [1, 1, 2, 3]))
        plans = [df._jdf.queryExecution().sparkPlan().toString() for df in (unique, repeated)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [p.count("ShuffledHashJoin") for p in plans] == [1, 2]
    assert not any("SortMergeJoin" in p for p in plans)
    assert sorted(r.doc_id for r in unique.collect()) == [0, 2, 3]
    assert sorted(r.doc_id for r in repeated.collect()) == [1, 2, 3]
