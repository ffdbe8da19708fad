import random

from tests.llm.brute import documents, sha, without_windows, words

from pyspark.sql import functions as F
from risklake.llm.substring import anchors, sliding_least, without_repeats
from risklake.llm.words import Texts


def compared(spark, texts, ids, window=50, **options):
    df = documents(spark, texts, ids).withColumn("kept", F.lit("clash"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in without_repeats(df, window=window, **options).collect())
    wanted = []
    for i, t, left in zip(ids, texts, without_windows(texts, ids, window), strict=True):
        n = len(words(t))
        wanted.append((i is None, i or 0, n, n - len(left), " ".join(left)))
    assert got == sorted(wanted)


def test_sliding_least():
    rng = random.Random(3)
    import numpy as np

    for k in (1, 2, 3, 7, 25):
        x = np.array([rng.random() for _ in range(60)])
        assert sliding_least(x, k).tolist() == [x[i : i + k].min() for i in range(60 - k + 1)]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    shared = [rng.choice("abcd") * rng.randint(1, 3) for _ in range(50)]
    texts = [" ".join([*("x%d" % rng.randint(0, 9) for _ in range(n)), *shared, "end"]).encode() for n in (0, 3, 40)]
    t = Texts(texts)
    found = [anchors(t.of(i), 50)[n] for i, n in enumerate((0, 3, 40))]
    assert found[0] == found[1] == found[2]


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = [rng.choice(vocabulary) for _ in range(90)]
    texts, ids = [], []
    for i in range(60):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if i % 3 == 0:
            a = rng.randint(0, 60)
            at = rng.randint(0, len(body))
            body[at:at] = passage[a : a + rng.randint(20, 90)]
        texts.append(" ".join(body))
        ids.append(i * 7 % 60)
    texts += [texts[0], texts[3], texts[3], None, "", " \t ", texts[6], "z " * 300, "z " * 120]
    ids += [100, 101, 102, 103, 104, 105, None, 106, 107]
    compared(spark, texts, ids)


def test_small_sketch_loses_nothing(spark):
    """With a sketch so full that every estimate is high, the exact pass decides alone."""
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randint(0, 3)}" for _ in range(rng.randint(0, 40))) for _ in range(80)]
    compared(spark, texts, list(range(80)), window=6, size=(64, 1), depth=1)
    compared(spark, texts, list(range(80)), window=6, size=(64, 3))


def test_one_id_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    compared(spark, [a, b, b, a + " tail", a], [5, 5, 5, 9, 2])


def test_empty_table_and_spaces(spark):
    df = documents(spark, ["  two \n words "])
    row = without_repeats(df).first()
    assert (row.n_words, row.n_removed, row.kept, sha(row.kept)) == (2, 0, "two words", sha("two words"))
    assert without_repeats(df.limit(0)).count() == 0
