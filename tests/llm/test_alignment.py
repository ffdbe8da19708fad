import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL
from tests.llm.brute import documents
from tokenizers import Tokenizer

from risklake.llm.alignment import alignment_digests, aligned, op13_alignment, terminals

BPE, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def byte_tokens(text, libraries):
    """(id, bytes) of both sides."""
    a, b = libraries
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in visible]
    back = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(hidden)}
    left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [
        (i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
        for i in b.encode(text)
    ]
    return left, right


def brute(texts, libraries):
    docs, counts = [], Counter()
    for text in texts:
        left, right = byte_tokens(text, libraries) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if not text or any(b"".join(x for _, x in side) != whole for side in (left, right)):
            docs.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for _, x in side]).tolist(), range(len(side)), strict=True)) for side in (left, right)]
        groups, links, at, bt = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            i, j = ends[0][end], ends[1][end]
            groups.append(",".join(str(x) for x, _ in left[at : i + 1]) + "|" + ",".join(str(x) for x, _ in right[bt : j + 1]))
            links.append((left[i][0], right[j][0]))
            at, bt = i + 1, j + 1
        counts.update(links)
        docs.append((len(left), len(right), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if d is None
        else (
            d[0], d[1], len(d[2]), len(d[3]), sum(counts[k] == most[k[1]] for k in d[3]), sum(counts[k] for k in d[3]),
            hashlib.sha256(";".join(d[2]).encode()).hexdigest(),
        )
        for d in docs
    ]


TEXTS = [
    "Plain words, and more of them.", "naïve café – Straße 日本語 🙂🙂", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b changes",
    "  two  spaces   three\n\n\ttabs ", "xxxxxxxx" * 40, "\x00\x01 controls\x7f", "it's they'll we'd", " ", "　\xa0wide", None, "",
    "aaaa " * 30000, "Plain words, and more of them.",
]


@pytest.mark.parametrize("head_pairs", [0, 5, 1_000_000])
def test_equals_the_libraries(spark, libraries, head_pairs):
    rows = alignment_digests(documents(spark, TEXTS).repartition(3), BPE, PIECES, head_pairs).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == brute(TEXTS, libraries)


def test_query(spark, libraries):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = {r.doc_id: tuple(r)[1:] for r in op13_alignment(spark, SMALL).collect()}
    assert rows == dict(zip(docs, brute(docs.values(), libraries), strict=True))


def test_repeated_and_missing_ids_and_other_columns(spark, libraries):
    texts = ["one text", "another one", "one text", "a third"]
    df = documents(spark, texts, [1, None, 1, None]).withColumnsRenamed({"lang": "pairs", "source": "groups", "n_chars": "_row"})
    rows = alignment_digests(df, BPE, PIECES).collect()
    assert sorted(tuple(r)[1:] for r in rows) == sorted(brute(texts, libraries))
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None", "None"]
    assert alignment_digests(df.limit(0), BPE, PIECES).count() == 0


def test_groups_and_links_are_real_output(spark):
    row = aligned(documents(spark, ["unbelievable naïveté"]), BPE, PIECES).first()
    groups = [[side.split(",") for side in g.split("|")] for g in row.groups.split(";")]
    assert sum(len(g[0]) for g in groups) == row.n_a and sum(len(g[1]) for g in groups) == row.n_b
    assert {(k >> 20, k & ((1 << 20) - 1)) for k in row.pairs} == {(int(a[-1]), int(b[-1])) for a, b in groups}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_pointers_end_where_both_sides_end(a, b):
    a, b = (np.array(sorted(x | {61})) for x in (a, b))
    common = np.intersect1d(a, b)
    terminal = terminals(a, b)
    for ends, got in ((a, terminal[: len(a)]), (b, terminal[len(a) :])):
        assert np.array_equal(a[got], common[np.searchsorted(common, ends)])
