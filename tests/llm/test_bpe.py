import hashlib
import random

import numpy as np
import pytest
from tests.conftest import SMALL
from tests.llm.brute import documents
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from risklake.llm.bpe import Encoder, Vocabulary, decode, decoded, encoded, op7_bpe, token_digests, vocabulary_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(vocabulary_path())


HARD = [
    "", " ", "  \n ", "a" * 3000, "aaaa aaa aa a", "'S don't we'll 've '' 's ''s it's", "x<|endoftext|> <|endoftext|><|endoftext|>y",
    "1²½ 中文 ́e \x1c \x85  x", "tab\tand\r\nline  end ", "😀 emoji‍", "_under_score__", "\x00zero",
]


def test_merges_name_later_tokens_only(vocabulary):
    """Merging all places of the lowest rank at once is exact when every merge outranks what it joins."""
    made = {int(t): r for r, t in enumerate(vocabulary.merged)}
    for key, rank in zip(vocabulary.keys.tolist(), vocabulary.ranks.tolist(), strict=True):
        assert all(made.get(part, -1) < rank for part in (key >> 32, key & 0xFFFFFFFF))


def test_same_ids_and_text_as_the_library(library, vocabulary):
    rng = random.Random(7)
    texts = HARD + ["".join(rng.choice("ab'stmrevld  \n\t1²_é中\x1c.-A😀") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    ids, counts = Encoder(vocabulary).encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    back = decode(vocabulary, ids.astype(np.int64), counts)
    for text, own, again in zip(texts, parts, back, strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert own.tolist() == wanted
        assert again == library.decode(wanted, skip_special_tokens=False)


def test_forgetting_words_changes_nothing(vocabulary):
    texts = [f"word{i} again word{i % 7}" for i in range(300)]
    small, large = Encoder(vocabulary, kept_words=5), Encoder(vocabulary)
    for t in texts:
        assert small.encode([t])[0].tolist() == large.encode([t])[0].tolist()


def test_tables(spark, library):
    texts = [*HARD, None, "same", "same", "long " * 60000]
    df = documents(spark, texts, [*range(len(HARD)), None, 5, 5, 99]).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    got = token_digests(df, vocabulary_path()).collect()
    assert len(got) == len(texts)
    wanted = sorted(
        (len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest())
        for e in (library.encode(t or "", add_special_tokens=False).ids for t in texts)
    )
    assert sorted((r.n_tokens, r.ids_sha256) for r in got) == wanted
    back = decoded(encoded(df.select("doc_id", "text"), vocabulary_path()), vocabulary_path())
    assert sorted(r.decoded for r in back.collect()) == sorted(t or "" for t in texts)
    assert token_digests(df.limit(0), vocabulary_path()).count() == 0


def test_query(spark, library):
    rows = {r.doc_id: r for r in op7_bpe(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
