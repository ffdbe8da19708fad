import random

import numpy as np
from tests.conftest import SMALL
from tests.llm.brute import documents, words

from risklake.llm.language_model import (
    CLASSES, OUTSIDE, SIDES, Network, classes, contexts, op4_pseudo_likelihood, scored,
)
from risklake.llm.words import Texts


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(1)
    network = Network.fresh(np.ones(CLASSES))
    network.parts = [p.astype(np.float64) for p in network.parts]
    context, target = rng.integers(0, CLASSES + 1, (7, len(SIDES))), rng.integers(0, CLASSES, 7)
    gradients = network.gradients(context, target)
    for part, slope in zip(network.parts, gradients, strict=True):
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in part.shape)
            keep, step = part[at], 1e-5
            part[at] = keep + step
            up = -network.log_chances(context, target).mean()
            part[at] = keep - step
            down = -network.log_chances(context, target).mean()
            part[at] = keep
            assert abs((up - down) / (2 * step) - slope[at]) < 1e-5


def test_contexts_stop_at_the_text():
    t = Texts([b"a b", b"", b"c d e f g"])
    found = np.arange(7)
    assert contexts(t, found, np.array([1, 2, 4])).tolist() == [
        [OUTSIDE, OUTSIDE, 0, OUTSIDE, OUTSIDE, OUTSIDE],
        [OUTSIDE, OUTSIDE, OUTSIDE, 3, 4, 5],
        [OUTSIDE, 2, 3, 5, 6, OUTSIDE],
    ]


def test_sums_are_those_of_each_word_alone():
    rng = np.random.default_rng(2)
    network, t = Network.fresh(rng.integers(1, 90, CLASSES)), Texts([b"one two three", b"four five six seven"])
    found = classes(t, np.sort(t.hashes[:3]))
    whole = network.log_chances(contexts(t, found, np.arange(7)), found)
    alone = [network.log_chances(contexts(t, found, np.array([i])), found[i : i + 1])[0] for i in range(7)]
    assert np.allclose(whole, alone, atol=1e-5)
    z = [network.log_chances(contexts(t, found, np.array([3])), np.array([c]))[0] for c in range(CLASSES)]
    assert abs(np.exp(z).sum() - 1) < 1e-4


def test_training_tells_order_from_disorder(spark):
    rng = random.Random(3)
    phrase = "the cat sat on a mat and ran far away".split()
    texts = [" ".join(phrase * rng.randint(20, 60)) for _ in range(150)]
    shuffled = []
    for t in texts[:30]:
        w = t.split()
        rng.shuffle(w)
        shuffled.append(" ".join(w))
    rows = scored(documents(spark, texts + shuffled).select("doc_id", "text"), rounds=3).collect()
    of = {r.doc_id: r.mean_log_likelihood for r in rows}
    assert np.mean([of[i] for i in range(150)]) > np.mean([of[i] for i in range(150, 180)]) + 1.0
    assert all(r.pseudo_log_likelihood <= 0 for r in rows)


def test_nulls_empty_long_and_clashes(spark):
    texts = ["a b c", None, "", " \t", "long " * 50000, "a b c"]
    df = documents(spark, texts, [1, 2, None, 3, 4, 1]).withColumnRenamed("n_chars", "n_tokens")
    rows = scored(df).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(words(t)) for t in texts)
    assert all((r.mean_log_likelihood is None) == (r.n_tokens == 0) for r in rows)
    assert all(r.pseudo_log_likelihood == 0 for r in rows if r.n_tokens == 0)
    same = {r.pseudo_log_likelihood for r in rows if r.doc_id == 1}
    assert len(same) == 1
    assert scored(df.limit(0)).count() == 0


def test_query(spark):
    rows = op4_pseudo_likelihood(spark, SMALL).collect()
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(words(t)) for i, t in docs.items()}


def test_a_rare_word_costs_more_than_a_common_one_of_its_ending(spark):
    """Both stand between the same words, outside the frequent ones, and end alike."""
    filler = [f"w{i:03d}x" for i in range(230)]
    texts = [" ".join(filler * 6)] * 3 + ["left common right " * 8, "left zqjxmon right " * 1 + "left common right " * 7]
    of = {r.doc_id: r.pseudo_log_likelihood for r in scored(documents(spark, texts).select("doc_id", "text")).collect()}
    n = {w: 15 for w in ("common",)} | {"zqjxmon": 1}
    assert abs((of[3] - of[4]) - np.log(n["common"] / n["zqjxmon"])) < 1e-3


def test_word_shares_sent_or_joined_give_the_same_scores(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5)) % 900}" for _ in range(200)) for _ in range(60)]
    df = documents(spark, texts).select("doc_id", "text").repartition(1)
    some, none, every = ({r.doc_id: r.pseudo_log_likelihood for r in scored(df, common=c).collect()} for c in (50, 0, 1 << 16))
    assert all(abs(some[i] - none[i]) < 1e-6 and abs(every[i] - none[i]) < 1e-6 for i in none)


def test_logits_beyond_the_bound_are_shifted(spark):
    rng = np.random.default_rng(6)
    network = Network.fresh(np.ones(CLASSES))
    context, target = rng.integers(0, CLASSES + 1, (9, len(SIDES))), rng.integers(0, CLASSES, 9)
    near = network.log_chances(context, target)
    network.parts[4] += np.float32(60)
    assert np.allclose(near, network.log_chances(context, target), atol=1e-4)
    network.parts[3] *= np.float32(400)
    assert np.isfinite(network.log_chances(context, target)).all()
