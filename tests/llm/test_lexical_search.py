import math
import re
from collections import Counter, defaultdict

from tests.conftest import SMALL
from tests.llm.brute import documents, small_letters

from risklake.llm import lexical_search as ls

ITEM = "item_id long, text string"


def brute(texts, ids, items, best):
    terms = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small_letters(t)) for t in texts]
    held = [(i, Counter(t), len(t)) for i, t in zip(ids, terms, strict=True) if t]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(list)
    for i, t in items:
        asked[i] += re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small_letters(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, c, n in held:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in wanted if t in c
            )
            scores.append((-score, i is None, i or 0, i))
        found = [(i, -s) for s, _, _, i in sorted(scores) if s < 0][:best]
        out += [(item, k + 1, i, s) for k, (i, s) in enumerate(found)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


#: Several shards, bundles and passes on a small input.
TINY = ls.Sizes(shard_documents=7, shard_postings=40, bundle_items=2, pass_terms=7)


def corpus():
    words = ["the", "of", "Über", "naïve", "x1", "rare", "code", "日本", "THE", "a-b", "c++", "it's"]
    return [" ".join(words[(i * k + k * k) % len(words)] for k in range(i % 9)) + (" uncommon" if i % 17 == 3 else "") for i in range(60)]


def test_equals_brute_force(spark):
    texts = corpus()
    items = [(1, "the rare code"), (2, "UNCOMMON über the the the"), (3, "日本 a b c"), (4, "absent words"), (5, "x1, it's")]
    docs = documents(spark, texts).repartition(3)
    assert found(ls.searched(docs, spark.createDataFrame(items, ITEM), 5, TINY)) == brute(texts, range(60), items, 5)


def test_one_shard_and_pass_agree(spark):
    texts = corpus()
    items = [(1, "the rare code"), (2, "UNCOMMON über the the the")]
    docs = documents(spark, texts)
    assert found(ls.searched(docs, spark.createDataFrame(items, ITEM))) == brute(texts, range(60), items, 10)


def test_nulls_ties_repeats_and_other_columns(spark):
    texts = ["same words here"] * 20 + [None, "", " \n-", "same " * 30000, "same words here", "words words"]
    ids = [*range(19), 18, 50, 51, 52, 53, None, None]
    items = [(1, "same words"), (1, "here"), (None, "words"), (7, None), (8, "!!")]
    docs = documents(spark, texts, ids).withColumnsRenamed({"lang": "score", "source": "rank", "n_chars": "terms"})
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], ITEM + ", n long")
    assert found(ls.searched(docs, asked, sizes=TINY)) == brute(texts, ids, items, 10)
    assert ls.searched(docs.limit(0), asked).count() == 0
    assert ls.searched(docs, asked.limit(0)).count() == 0


def test_query(spark):
    got = ls.op12_search(spark, SMALL)
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = brute([d.text for d in docs], [d.doc_id for d in docs], [(b.item_id, b.text) for b in items], 10)
    assert found(got) == want
