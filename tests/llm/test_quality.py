import random

import numpy as np
from tests.conftest import MEDIUM
from tests.llm.brute import documents

from pyspark.sql import functions as F
from risklake.llm import quality as module
from risklake.llm.quality import STEPS, CorpusPool, Logistic, co_trained, op2_quality, quality

LABEL = "doc_id long, quality int, toxic int"


def test_held_out_labels(spark):
    """Fitted without the labels of a fifth of the documents, the classifier finds them."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    hidden = {r.doc_id: r.quality for r in labels.collect() if r.doc_id % 5 == 1}
    scored = {r.doc_id: r.quality_score for r in quality(docs, labels.filter("doc_id % 5 <> 1")).collect()}
    good = np.mean([scored[i] >= 0.5 for i, q in hidden.items() if q == 1])
    bad = np.mean([scored[i] < 0.5 for i, q in hidden.items() if q == 0])
    assert good > 0.98 and bad > 0.9


def test_query(spark):
    rows = op2_quality(spark, MEDIUM).collect()
    assert len(rows) == 1000 and all(r.keep == (r.score >= 0.5) for r in rows)


def test_views_teach_each_other():
    """Few labels, two noisy views: the pseudo-labels improve on what the seed alone gives."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 3000)
    views = [(y[:, None] * 2 - 1) * 0.8 + rng.normal(0, 1.2, (3000, 6)) for _ in range(2)]
    label = np.where(np.arange(3000) < 40, y, -1)
    model = co_trained([v.astype(np.float32) for v in views], label)
    alone = Logistic(penalty=3.0).fit(views[0][:30], y[:30])
    right = np.mean((model.chance(*views)[40:] >= 0.5) == y[40:])
    assert right > 0.9 and right >= np.mean((alone.log_odds(views[0][40:]) >= 0) == y[40:])


def test_nulls_empty_and_missing_columns(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["the", "and", "house", "river"]) for _ in range(40)) + "." for _ in range(60)]
    bad = [" ".join(rng.choice(["###", "$$$", "@@"]) for _ in range(40)) for _ in range(60)]
    texts = [*good, *bad, None, "", "w " * 60000, good[0], good[0]]
    ids = [*range(120), 120, 121, 122, None, 0]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)] + [(None, 1, 0), (5, None, None), (2, 0, 0)], LABEL)
    df = documents(spark, texts, ids)
    rows = quality(df.withColumnRenamed("n_chars", "quality_score"), labels).collect()
    assert len(rows) == len(texts)
    of = {r.doc_id: r.quality_score for r in rows}
    assert of[120] == of[121] == 0.0
    assert np.mean([of[i] > 0.5 for i in range(1, 60, 2)]) > 0.9 and np.mean([of[i] < 0.5 for i in range(61, 120, 2)]) > 0.9
    assert quality(df.select("doc_id", "text"), labels).columns == ["doc_id", "text", "quality_score"]
    assert quality(df.limit(0), labels).count() == 0
    assert {r.quality_score for r in quality(df, labels.limit(0)).filter("doc_id < 60").collect()} == {1.0}


def test_the_surest_of_all_unlabelled_documents_are_named(spark):
    """Against a sort of all log odds: no named document is less sure by more than a step."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    given = module._judged(docs.unionByName(docs.limit(3)).repartition(3))
    known = spark.range(0, 1000, 3).select(F.col("id").alias("doc_id"))
    every = module._fetched(given, given.select("doc_id", "_q_hash", F.lit(0).alias("_q_code")).distinct())
    ids, views = np.array(every["doc_id"].to_pylist()), module._both_views(every)
    y = (np.arange(len(ids)) % 2).astype(int)
    y[views[0][:, 0] > np.median(views[0][:, 0])] = 1
    models = [Logistic(penalty=0.1).fit(v, y) for v in views]
    odds = [m.log_odds(v) for m, v in zip(models, views, strict=True)]
    labelled = {r.doc_id for r in known.collect()}
    free = np.array([i not in labelled for i in ids])
    pool, seen, shares = CorpusPool(given, known), set(), {0: 7, 1: 12}
    for call in range(2):
        before = len(pool.taught)
        taught = pool.surest(models, shares)
        new = pool.taught[before:]
        assert len(new) == sum(len(values) for _, values in taught)
        for giver in (0, 1):
            of = np.array([i for i, _, g in new if g == giver], dtype=int)
            assert not labelled & set(of.tolist()) and not {(i, giver) for i in of.tolist()} & seen
            named = odds[giver][np.isin(ids, of)]
            for value, sign in ((1, 1), (0, -1)):
                sure = np.sort(sign * odds[giver][free & (sign * odds[giver] > np.log(19))])[::-1]
                got = sign * named[sign * named > 0]
                if len(got):
                    assert got.min() >= sure[min(len(sure), shares[value] * (call + 2)) - 1] - 1 / STEPS
                if call == 0 and len(sure) <= shares[value]:
                    assert len(got) == len(sure)
            seen |= {(i, giver) for i in of.tolist()}
    assert seen


def test_rows_of_a_sampled_id_are_folded(spark):
    df = documents(spark, ["a b c."] * 500 + ["x y z!"] * 300 + ["### $$"], [1] * 800 + [2])
    given = module._judged(df.repartition(4))
    wanted = given.select("doc_id", "_q_hash", F.lit(1).alias("_q_code")).distinct()
    assert module._fetched(given, wanted).num_rows == 3
