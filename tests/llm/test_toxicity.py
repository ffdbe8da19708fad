import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.conftest import SMALL
from tests.llm.brute import documents

from risklake.llm import toxicity as tox
from risklake.llm.toxicity import logistic, op9_toxicity, toxicity
from risklake.llm.words import NOT_PLAIN, Texts

LARGE = "/root/testdata/sf0.1"

LABEL = "doc_id long, quality int, toxic int"
INSULTS = ["blockhead", "nitwit", "dunce"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        body = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                body.insert(rng.randint(0, len(body)), rng.choice(INSULTS) + rng.choice(["", ",", "!"]))
        texts.append(" ".join(body).capitalize())
        labels.append((i, 1, int(toxic)))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus(900)
    rows = toxicity(documents(spark, texts), spark.createDataFrame(labels, LABEL)).collect()
    toxic = {i: t for i, _, t in labels}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_scores_come_from_the_text_alone(spark):
    texts, labels = corpus(400, seed=2)
    frame = spark.createDataFrame(labels, LABEL)
    by_id = {r.doc_id: r.score for r in toxicity(documents(spark, texts), frame).collect()}
    twice = documents(spark, texts + texts, [*range(400), *range(1000, 1400)])
    again = {r.doc_id: r.score for r in toxicity(twice, frame).collect()}
    assert all(again[i] == again[i + 1000] for i in range(400))
    assert by_id.keys() < again.keys()


def test_nulls_empty_and_one_class(spark):
    texts, labels = corpus(300, seed=3)
    texts += [None, "", " \n", "idle " * 40000, texts[0]]
    ids = [*range(300), 300, 301, None, 302, 0]
    labels += [(None, 1, 1), (7, None, None), (8, 0, 1), (8, 0, 0)]
    df, frame = documents(spark, texts, ids).withColumnRenamed("n_chars", "score"), spark.createDataFrame(labels, LABEL)
    rows = toxicity(df, frame).collect()
    assert len(rows) == len(texts) and all(r.score is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id in (300, 301)}) == 1
    assert toxicity(df.limit(0), frame).count() == 0
    assert {r.score for r in toxicity(df, frame.filter("toxic = 0")).collect()} == {0.0}
    assert {r.score for r in toxicity(df, frame.limit(0)).collect()} == {0.0}


def test_logistic_finds_the_curve():
    rng = np.random.default_rng(1)
    x = rng.normal(2.0, 3.0, 20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.7 * x - 1.0)))).astype(float)
    intercept, slope = logistic(x, y)
    assert abs(slope - 0.7) < 0.05 and abs(intercept + 1.0) < 0.1


def test_query(spark):
    rows = op9_toxicity(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_a_rare_and_a_fixed_expression_are_evidence(spark):
    """One insult always follows the same word, another is in few documents."""
    texts, labels = corpus(900, seed=5)
    rng = random.Random(6)
    for i, _, toxic in labels:
        if toxic and i % 8 == 0:
            texts[i] += " you oaf"
        elif rng.random() < 0.5:
            texts[i] += f" you w{rng.randint(0, 400)}"
        if toxic and i % 100 == 0:
            texts[i] += f" w{i} clod w{i + 1}"
    base = " ".join(f"w{i}" for i in range(20))
    asked = [base + " you seldom", base + " you oaf", base + " seldom", base + " clod"]
    df = documents(spark, texts + asked, [*range(900), 2000, 2001, 2002, 2003])
    score = {r.doc_id: r.score for r in toxicity(df, spark.createDataFrame(labels, LABEL)).collect()}
    assert score[2001] > score[2000] and score[2003] > score[2002]


def area(scores, labels):
    """Chance that a toxic document scores above an ordinary one, ties half."""
    pairs = [(a > b) + 0.5 * (a == b) for a, x in zip(scores, labels, strict=True) if x for b, y in zip(scores, labels, strict=True) if not y]
    return np.mean(pairs)


def test_held_out_documents_of_the_given_tables(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect() if r.toxic is not None}
    held = [r for r in op9_toxicity(spark, LARGE).collect() if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in held])
    found = np.array([r.predicted for r in held])
    assert found[truth == 1].mean() >= 0.85 and found[truth == 0].mean() <= 0.01
    assert area([r.score for r in held], truth) >= 0.92


def plain_models(texts, labels):
    """Both classes' conditional probabilities by the definition."""
    words = [[w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", t.lower()) if w] for t in texts]
    counts = [[Counter(), Counter()], [Counter(), Counter()]]
    seen = set()
    for w, y in zip(words, labels, strict=True):
        edged, first = ["<start>", "<start>", *w, "<start>"], {}
        for p in range(2, len(edged) - 1):
            first.setdefault((0, edged[p]), (edged[p - 1], edged[p + 1]))
            first.setdefault((1, (edged[p - 1], edged[p])), (edged[p - 2], edged[p + 1]))
        seen |= {(kind, key, around, y) for (kind, key), around in first.items()}
    for kind, key, _, y in seen:
        counts[kind][y][key] += 1
    both = [c[0] + c[1] for c in counts]
    total = [[sum(c.values()) for c in pair] for pair in counts]
    left = []
    for pair, pooled, sizes in zip(counts, both, total, strict=True):
        of_kind = []
        for y in (0, 1):
            n = Counter(pair[y].values())
            d = tox.discounts(n[1], n[2], n[3], n[4])
            share = sizes[y] / sum(sizes)
            of_kind.append({})
            for k, c in pair[y].items():
                expected = pooled[k] * share
                over = max(0.0, c - expected - d[min(c, 3) - 1])
                errors = (over / math.sqrt(expected) / tox.MARGIN) ** tox.STEEP
                of_kind[y][k] = over * errors / (errors + 1)
        left.append(of_kind)

    def word(w, y):
        shared = (both[0][w] + 1) / (sum(total[0]) + len(both[0]) + 1)
        return left[0][y].get(w, 0.0) / total[0][y] + (1 - sum(left[0][y].values()) / total[0][y]) * shared

    n, kept = [Counter(), Counter()], [defaultdict(float), defaultdict(float)]
    for y in (0, 1):
        for (v, _), c in counts[1][y].items():
            n[y][v] += c
        for (v, _), x in left[1][y].items():
            kept[y][v] += x

    def pair(v, w, y):
        rest = n[y][v] - kept[y][v] + tox.STRENGTH
        return (left[1][y].get((v, w), 0.0) + rest * word(w, y)) / (n[y][v] + tox.STRENGTH)

    return pair


def test_equals_kneser_ney_by_the_definition(spark):
    texts, labels = corpus(300, seed=9)
    y = [t for _, _, t in labels]
    for i in range(300):
        texts[i] += " you oaf" if y[i] else " you there" if i % 2 else ""
    frame = spark.createDataFrame([(t.encode(), k) for t, k in zip(texts, y, strict=True)], "text binary, label long")
    model = tox.fitted(tox._counted(frame))
    assert any(len(keys) for keys, _ in model.tables[2:])
    pair = plain_models(texts, y)
    for asked in (texts[0], "you oaf", "never seen words", "Nitwit, w1 w2 you nitwit", texts[4]):
        w = [x for x in re.split(r"[^0-9a-z]+", asked.lower()) if x]
        ratios = [math.log(pair(v, x, 1) / pair(v, x, 0)) for v, x in zip(["<start>", *w[:-1]], w, strict=True)]
        got = model.evidence(Texts([asked.lower().encode()], NOT_PLAIN))[0]
        assert got == pytest.approx(np.mean(ratios), rel=1e-9, abs=1e-12)


def test_a_repeated_id_teaches_once(spark):
    texts, labels = corpus(200, seed=10)
    many = documents(spark, texts + ["dull text"] * 3000, [*range(200), *[201] * 3000])
    frame = spark.createDataFrame([*labels, (201, 1, 0)], LABEL)
    rows = toxicity(many, frame).collect()
    assert len(rows) == 3200 and len({r.score for r in rows if r.doc_id == 201}) == 1


def test_every_labelled_text_is_counted(spark, monkeypatch):
    """More labels than a sample would hold: all of folds 1 to 3 give counts, all of fold 4 calibrate."""
    docs = spark.range(60_000).selectExpr("id AS doc_id", "concat('w', id, ' ', if(id % 2 = 0, 'good', 'bad')) AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    folds = {r[0]: r[1] for r in docs.selectExpr("crc32(string(doc_id)) % 5 AS f").groupBy("f").count().collect()}
    taught, calibrated, counted, logistic = [], [], tox._counted, tox.logistic_of_rows
    monkeypatch.setattr(tox, "_counted", lambda df: taught.append(df.count()) or counted(df))
    monkeypatch.setattr(tox, "logistic_of_rows", lambda df: calibrated.append(df.count()) or logistic(df))
    toxicity(docs, labels)
    assert taught == [folds[1] + folds[2] + folds[3]] and calibrated == [folds[4]]


def test_no_text_moves_that_is_not_repeated(spark, monkeypatch):
    """The texts that teach are picked by ids and hashes; only repeated rows are gathered to drop one."""
    plans, write = {}, tox.kept

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(tox, "kept", noted)
    rows = [(i, f"word{i % 7} {'bad' if i % 3 == 0 else 'good'} thing{i}") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    once = tox.toxicity(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    alone = {r.doc_id: r.score for r in once.collect()}
    assert plans["toxic-taught"].count("Exchange") == plans["toxic-taught"].count("BroadcastExchange")
    twice = tox.toxicity(spark.createDataFrame(rows + rows[:20], "doc_id long, text string"), labels)
    assert {r.doc_id: r.score for r in twice.collect()} == alone


def test_counts_of_passes_and_buckets(spark, monkeypatch):
    """Copies count once, whatever the buckets and buffers; no surroundings stay on disk."""
    texts, labels = corpus(300, seed=12)
    texts, y = texts + texts[:100] + ["", "word"], [t for _, _, t in labels] + [t for _, _, t in labels[:100]] + [0, 1]
    frame = spark.createDataFrame([(t.encode(), k) for t, k in zip(texts, y, strict=True)], "text binary, label long").repartition(3)
    texts_given = tox.kept(frame, "test-texts")
    seen, key = set(), lambda *words: tuple(int(h) for h in Texts([" ".join(words).encode()], NOT_PLAIN).hashes.view(np.int64))
    for t, toxic in zip(texts, y, strict=True):
        w = re.findall("[0-9a-z]+", t.lower())
        edged, first = ["", "", *w, ""], {}
        for p in range(2, len(edged) - 1):
            first.setdefault((0, "-", edged[p]), (edged[p - 1], edged[p + 1]))
            first.setdefault((1, edged[p - 1], edged[p]), (edged[p - 2], edged[p + 1]))
        seen |= {(*k, around, toxic) for k, around in first.items()}
    wanted = Counter((kind, *(0 if v == "-" else 1 if v == "" else key(v)[0] for v in (before, word)), toxic) for kind, before, word, _, toxic in seen)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = blocks.getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_") and f.endswith(".data")}

    for bucket_bytes, buffer_rows in ((1 << 20, 1 << 20), (50, 700)):
        monkeypatch.setattr(tox, "BUCKET_BYTES", bucket_bytes)
        monkeypatch.setattr(tox, "BUFFER_ROWS", buffer_rows)
        before, write, left = shuffled(), tox.kept, []

        def noted(df, name):
            out = write(df, name)
            left.append(shuffled() - before)  # noqa: B023
            return out

        monkeypatch.setattr(tox, "kept", noted)
        counts = tox._counted(texts_given)
        monkeypatch.setattr(tox, "kept", write)
        assert len(left) == 4 and len(left[3]) <= len(left[0])
        got = Counter()
        for r in counts.collect():
            got.update({(r.kind, r.before, r.word, 0): r.ordinary, (r.kind, r.before, r.word, 1): r.toxic})
        assert +got == wanted and counts.count() == len({k[:3] for k in wanted})


def test_what_no_probability_holds_is_no_entry(spark):
    """Toxic bigrams that occur once are 0.0001 above their discount: all of them, and by nothing that counts."""
    words = [(tox.WORDS, 0, w, 200, 30) for w in range(50)]
    times = [1] * 1000 + [2] * 60 + [3] * 10 + [4] * 5 + [40]
    toxic = [(tox.PAIRS, 1000 + i, i % 50, 0, n) for i, n in enumerate(times)]
    ordinary = [(tox.PAIRS, 5000 + i, i % 50, 18, 0) for i in range(561)]
    counts = spark.createDataFrame(words + toxic + ordinary, "kind int, before long, word long, ordinary long, toxic long")
    rows, _, _ = tox._excess(counts)
    once = rows.filter("kind = 1 AND toxic = 1")
    assert once.filter("toxic_left > 0 AND toxic_left < 1e-24").count() == 1000
    model = tox.fitted(counts)
    strong = 76 + 561
    assert [len(keys) for keys, _ in model.tables[1:]] == [strong, strong]
    before, word = np.array([1000, 2075], np.uint64), np.array([0, 25], np.uint64)
    plain = model.log_ratio(np.array([9, 9], np.uint64), word)
    found = model.log_ratio(before, word)
    assert found[0] == plain[0] and found[1] > plain[1] + 1


def test_a_model_in_parts_is_whole(spark, monkeypatch):
    """Whatever a task holds at once, every word, context and bigram with evidence has its say."""
    texts, labels = corpus(600, seed=14)
    for i, _, toxic in labels:
        texts[i] += " you oaf" if toxic else " you there" if i % 2 else " thank you"
    frame = spark.createDataFrame([(t.encode(), y) for t, (_, _, y) in zip(texts, labels, strict=True)], "text binary, label long")
    counts = tox.kept(tox._counted(frame), "test-counts")
    whole = tox.fitted(counts)
    fewest = min(len(keys) for keys, _ in whole.tables)
    assert whole.bits == (0, 0, 0) and fewest > 1
    parted = tox.fitted(counts, fewest - 1)
    assert min(parted.bits) > 0 and len(parted.tables) == sum(1 << b for b in parted.bits)
    assert sum(len(t.value[0]) for t in parted.tables) == sum(len(keys) for keys, _ in whole.tables)
    given = Texts([t.lower().encode() for t in texts], NOT_PLAIN)
    assert parted.evidence(given) == pytest.approx(whole.evidence(given), rel=1e-9, abs=1e-12)
    df, labelled = documents(spark, texts).repartition(3), spark.createDataFrame(labels, LABEL)
    alone = {r.doc_id: r.score for r in toxicity(df, labelled).collect()}
    monkeypatch.setattr(tox, "MODEL_ENTRIES", fewest - 1)
    monkeypatch.setattr(tox, "LOOKED_UP", 2000)
    assert {r.doc_id: r.score for r in toxicity(df, labelled).collect()} == pytest.approx(alone, rel=1e-6, abs=1e-12)
