import math
import random
import zlib

import pytest
from tests.conftest import MEDIUM
from tests.llm.brute import documents

from risklake.llm.language_id import EDGE, LONGEST, SMOOTHING, Languages, fitted, language, op11_language, words_of

SYLLABLES = {"en": ["th", "ing", "er", "wh"], "de": ["sch", "ung", "ie", "ß"], "fr": ["eau", "ç", "oi", "è"]}


def corpus(n, seed=1):
    rng = random.Random(seed)
    texts, langs = [], []
    for _ in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        word = lambda: "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 6)))
        texts.append(" ".join(word() for _ in range(rng.randint(3, 30))).capitalize())
        langs.append(lang)
    return texts, langs


def labelled(spark, texts, langs, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, langs, strict=True)), "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    texts, langs = corpus(400)
    rows = language(labelled(spark, texts, langs)).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.lang_pred == langs[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_query_on_the_given_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in op11_language(spark, MEDIUM).collect() if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.97 * len(held)


def plain_score(texts, langs, asked):
    """Log likelihoods by the definition: known words first, then the longest known n-gram at each position."""
    names = sorted(set(langs))
    counts = {}
    for text, lang in zip(texts, langs, strict=True):
        for w in words_of(text):
            edged = EDGE + w + EDGE
            keys = [(0, w)] + [(b - a, edged[a:b]) for b in range(1, len(edged) + 1) for a in range(max(0, b - LONGEST), b)]
            for k in keys:
                counts.setdefault(k, dict.fromkeys(names, 0))[lang] += 1
    total = {(o, x): sum(c[x] for k, c in counts.items() if k[0] == o) for o in range(LONGEST + 1) for x in names}
    room = {o: SMOOTHING * (1 + sum(k[0] == o for k in counts)) for o in range(LONGEST + 1)}

    def log(key, lang):
        return math.log((counts[key][lang] + SMOOTHING) / (total[key[0], lang] + room[key[0]]))

    out = dict.fromkeys(names, 0.0)
    for w in words_of(asked):
        edged = EDGE + w + EDGE
        for lang in names:
            if (0, w) in counts:
                out[lang] += log((0, w), lang)
                continue
            for b in range(2, len(edged) + 1):
                key = next(((b - a, edged[a:b]) for a in range(max(0, b - LONGEST), b) if (b - a, edged[a:b]) in counts), None)
                if key is None:
                    out[lang] += math.log(SMOOTHING / (total[1, lang] + room[1]))
                else:
                    out[lang] += log(key, lang) / key[0]
    return out


@pytest.mark.parametrize("asked", ["thing unthing schunge", "qqq Eauç, eau 12", "x" * 100 + " th"])
def test_equals_the_definition(spark, asked):
    texts, langs = corpus(30, seed=4)
    model = fitted(labelled(spark, texts, langs).select("text", "lang"))
    assert isinstance(model, Languages)
    got = model.scores([asked, "th", asked])[0]
    want = plain_score(texts, langs, asked)
    for row in (got[0], got[2]):
        assert row == pytest.approx([want[x] for x in model.names], rel=1e-9)


def test_a_small_model_still_backs_off(spark):
    texts, langs = corpus(300, seed=5)
    rows = language(labelled(spark, texts, langs), model_cells=3 * 6 * 40).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.9 * len(held)


def test_text_alone_decides(spark):
    texts, langs = corpus(200, seed=6)
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 == 2]
    asked = [ids[0], ids[1], ids[2]]
    df = labelled(spark, texts + [texts[0]] * 3, langs + ["de", None, "zz"], [*range(10_000, 10_200), *asked])
    rows = {r.doc_id: (r.lang_pred, r.score) for r in language(df).collect()}
    assert len({rows[i] for i in [*asked, 10_000]}) == 1


def test_nulls_empty_and_long_texts(spark):
    texts, langs = corpus(100, seed=7)
    odd = [None, "", " 12 ² ...\n", "ß" * 200_000, "eau " * 50_000, "日本語"]
    df = labelled(spark, texts + odd + texts[:2], langs + [None] * 6 + langs[:2], [*range(100), *range(500, 505), None, 0, 0])
    df = df.selectExpr("*", "1 AS score", "'x' AS lang_pred", "2 AS n")
    rows = language(df).collect()
    assert len(rows) == 108
    by_id = {r.doc_id: r for r in rows if (r.doc_id or 0) >= 500}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (500, 501, 502))
    assert by_id[503].lang_pred == "de" and by_id[504].lang_pred == "fr"
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert language(df.limit(0)).count() == 0
    nothing = language(documents(spark, ["words", "more"]).selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_a_copied_id_teaches_once(spark):
    texts, langs = corpus(60, seed=8)
    many = labelled(spark, texts + ["thing"] * 5000, langs + ["en"] * 5000, [*range(60), *[61] * 5000])
    once = labelled(spark, texts + ["thing"], langs + ["en"], [*range(60), 61])
    got, want = ({r.doc_id: r.score for r in language(df, sample_rows=100_000).collect()} for df in (many, once))
    assert got == pytest.approx(want)
