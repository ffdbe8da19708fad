"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to its farthest-right
overlapping token, or to itself where nothing reaches farther; replacing each
pointer by its target's pointer, over and over, doubles the distance it spans and
ends at the terminal token of the component. Components are the groups between
offsets at which tokens of both sides end.

How often two token ids end together is counted over the whole corpus. Pairs seen
often are looked up in a broadcast table of bounded size, the others by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.llm.bpe import Encoder, Vocabulary, gather, vocabulary_path
from risklake.llm.scratch import dropped, kept
from risklake.llm.words import by_arrow, chunks

#: Pairs of ids that are broadcast with their counts, the most frequent ones.
HEAD_PAIRS = 1_000_000
SPACE = "▁"

_ALIGNED = (
    "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"
)


def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first = np.zeros(len(entries) + 1, np.int64)
    np.cumsum([len(e) for e in entries], out=first[1:])
    return np.frombuffer(b"".join(entries), np.uint8), first


class Pieces:
    """A sentencepiece model: ids of texts, and the bytes of every id."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(size)]
        self.bytes, self.first = _table(
            [
                bytes([int(n[3:5], 16)]) if self.model.is_byte(i)
                else b"" if self.model.is_control(i) or self.model.is_unknown(i)
                else n.replace(SPACE, " ").encode("utf-8", "surrogatepass")
                for i, n in enumerate(names)
            ]
        )

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids, flat, and how many each text has."""
        found = self.model.encode(texts, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.array(f, np.int64) for f in found]), counts


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each token, A's first, the terminal token of its component.

    Ends are ascending byte positions of tokens that cover the same bytes. The
    farthest-right token that overlaps a token is the one that holds its last byte;
    where both end together, B's token points to A's, which ends the component.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the token of B that holds the last byte
    over_b = np.searchsorted(a_ends, b_ends)
    here = np.arange(n)
    pointer = np.concatenate([np.where(b_ends[over_a] > a_ends, over_a + n, here), over_b])
    while True:
        jumped = pointer[pointer]
        if np.array_equal(jumped, pointer):
            return pointer
        pointer = jumped


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


@dataclass
class Aligner:
    """Both tokenizers in a task, and the digits of every id with what may stand behind it."""

    a: Vocabulary
    b: Pieces

    def __post_init__(self):
        self.encoder = Encoder(self.a)
        sizes = len(self.a.token_first) - 1, len(self.b.first) - 1
        self.digits, self.digits_first = _table(
            [f"{i}{sep}".encode() for size, seps in zip(sizes, (",|", ",;"), strict=True) for i in range(size) for sep in seps]
        )
        self.b_digits = 2 * sizes[0]

    def _whole(self, texts: list[str]) -> tuple:
        """Ids, counts and byte ends of both sides; a text that one side changes has no tokens."""
        spaced = [" " + t if t else "" for t in texts]
        ids_a, n_a = self.encoder.plain(spaced)
        ids_b, n_b = self.b.encode(texts)
        ids_a = ids_a.astype(np.int64)
        sides = []
        for ids, counts, data, first in (
            (ids_a, n_a, self.a.token_bytes, self.a.token_first), (ids_b, n_b, self.b.bytes, self.b.first)
        ):
            length = first[ids + 1] - first[ids]
            ends = np.append(0, np.cumsum(length))
            bounds = ends[np.append(0, np.cumsum(counts))].tolist()
            sides.append((ids, counts, ends[1:], gather(data, first[ids], length).tobytes(), bounds))
        given = [t.encode("utf-8", "surrogatepass") for t in spaced]
        keep = np.array(
            [all(s[3][s[4][i] : s[4][i + 1]] == g for s in sides) for i, g in enumerate(given)], bool
        )
        if keep.all():
            return tuple(x for s in sides for x in s[:3])
        kept_ids = [(s[0][np.repeat(keep, s[1])], np.where(keep, s[1], 0)) for s in sides]
        firsts = (self.a.token_first, self.b.first)
        return tuple(
            x for (ids, n), f in zip(kept_ids, firsts, strict=True) for x in (ids, n, np.cumsum(f[ids + 1] - f[ids]))
        )

    def align(self, texts: list[str]) -> list[pa.Array]:
        """The columns of the schema ``_ALIGNED``."""
        ids_a, n_a, ends_a, ids_b, n_b, ends_b = self._whole(texts)
        n = len(texts)
        text_a, text_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        if not len(ids_a):
            none, nothing = np.zeros(n, np.int64), np.zeros(0, np.int64)
            return [
                *[pa.array(none)] * 4, pa.array([""] * n), _lists(nothing, none, pa.int64()), _lists(nothing, none, pa.int32())
            ]
        # Ends grow over all texts, and every text ends on both sides.
        terminal = terminals(ends_a, ends_b)
        group_a, group_b = terminal[: len(ids_a)], terminal[len(ids_a) :]
        last_a = group_a == np.arange(len(ids_a))
        last_b = ends_b == ends_a[group_b]
        link_a, link_b, link_text = ids_a[last_a], ids_b[last_b], text_a[last_a]
        n_links = np.bincount(link_text, minlength=n)
        key = (link_text << 40) | (link_a << 20) | link_b
        found, times = np.unique(key, return_counts=True)
        per_text = np.bincount(found >> 40, minlength=n)
        return [
            pa.array(n_a), pa.array(n_b), pa.array(n_links), pa.array(n_links),
            pa.array(self._groups(ids_a, group_a, last_a, text_a, ids_b, group_b, last_b, text_b, n)),
            _lists(found & ((1 << 40) - 1), per_text, pa.int64()),
            _lists(times.astype(np.int32), per_text, pa.int32()),
        ]

    def _groups(self, ids_a, group_a, last_a, text_a, ids_b, group_b, last_b, text_b, n) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        entries = np.concatenate([2 * ids_a + last_a, self.b_digits + 2 * ids_b + last_b])
        # By group, A's tokens first; both sides are in order already.
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        entries = entries[order]
        length = self.digits_first[entries + 1] - self.digits_first[entries]
        data = gather(self.digits, self.digits_first[entries], length).tobytes()
        per_text = np.bincount(text_a, minlength=n) + np.bincount(text_b, minlength=n)
        bounds = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(per_text))].tolist()
        return [data[a : max(a, b - 1)].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def aligned(docs: DataFrame, bpe: str, pieces: str, text: str = "text", others: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, per row.

    ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``groups`` as
    `a1,a2|b1;a3|b2,b3`, and the distinct linked id pairs (A's id * 2**20 + B's id)
    with how often each is linked. ``bpe`` is a byte-level BPE file, ``pieces`` a
    sentencepiece model that adds a space; both files are read on the driver and
    broadcast. Special tokens' strings are plain text. NULL and empty texts, and
    those whose bytes one side changes, have no tokens: zeros and empty values.
    Keeps the columns ``others`` and drops all else.
    """
    with open(pieces, "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((Vocabulary.load(bpe), model))
    given = docs.select(*others, F.col(text).alias("_text"))
    schema = T.StructType(docs.select(*others).schema.fields + T.StructType.fromDDL(_ALIGNED).fields)
    names = [*others, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        aligner = Aligner(vocabulary, Pieces(model))
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            for a, b in chunks(map(len, texts)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), *aligner.align(texts[a:b])], names=names)

    return by_arrow(given, task, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): links of each pair over all rows, and whether no other pair of its B id has more."""
    counts = kept(
        rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("l"))
        .groupBy(F.col("l.pairs").alias("pair")).agg(F.sum("l.times").alias("n")),
        "pair-counts",
    )
    b = F.col("pair").bitwiseAND(F.lit((1 << 20) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # one row per entry of B's vocabulary
    out = kept(
        counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
        "pair-best",
    )
    dropped(counts)
    return out


def frequent(counts: DataFrame, most: int = HEAD_PAIRS) -> DataFrame:
    """The pairs seen at least 2**k times, for the least k that leaves at most ``most`` of them."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = sorted(counts.groupBy(level.alias("k")).count().collect(), reverse=True)  # at most 63 rows
    total, least = 0, 64
    for k, size in sizes:
        total += size
        if total > most:
            break
        least = k
    return counts.filter(level >= least)


def alignment_counts(rows: DataFrame, row: str, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(row, n_best, count_sum) of rows with ``pairs`` and ``times``, for rows that have links.

    ``row`` identifies a row. Counts of frequent pairs are broadcast (two numbers for
    each of ``head_pairs``), only the other links are joined.
    """
    counts = pair_counts(rows)
    head = frequent(counts, head_pairs)
    table = head.toArrow()
    keys = table["pair"].to_numpy()
    order = np.argsort(keys)
    found = keys[order], table["n"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False)[order]
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = shared.value
        for batch in batches:
            pairs, times = (batch.column(c) for c in ("pairs", "times"))
            size = np.diff(pairs.offsets.to_numpy())
            owner = np.repeat(np.arange(len(size)), size)
            pairs, times = (x.flatten().to_numpy().astype(np.int64) for x in (pairs, times))
            at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            sums = np.zeros((2, len(size)), np.int64)
            for total, value in zip(sums, (best, n), strict=True):
                np.add.at(total, owner[hit], times[hit] * value[at[hit]])
            left = np.bincount(owner[~hit], minlength=len(size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(row), *map(pa.array, sums),
                    _lists(pairs[~hit], left, pa.int64()), _lists(times[~hit], left, pa.int64()),
                ],
                names=[row, "n_best", "count_sum", "pairs", "times"],
            )

    schema = f"{row} long, n_best long, count_sum long, pairs array<long>, times array<long>"
    first = kept(rows.select(row, "pairs", "times").mapInArrow(task, schema), "pair-sums")
    rare = first.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        row, F.col("l.pairs").alias("pair"), F.col("l.times").alias("times")
    )
    tail = rare.join(counts, "pair").select(
        row, F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    both = first.select(row, "n_best", "count_sum").unionByName(tail)
    out = kept(both.groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "pair-totals")
    dropped(counts, first)
    return out


def alignment_digests(docs: DataFrame, bpe: str, pieces: str, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Per document: numbers of tokens, groups and links, corpus-wide counts, and the digest of the groups.

    Every row is a document of its own, also where ids repeat or are NULL. Documents
    without tokens have zeros and '' as digest. An empty table gives no rows. Needs
    doc_id and text; other columns are ignored.
    """
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    both = aligned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bpe, pieces)
    rows = kept(both.select(F.monotonically_increasing_id().alias("_row"), "*", digest).drop("groups"), "aligned")
    totals = alignment_counts(rows, "_row", head_pairs)
    return rows.join(totals, "_row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    return alignment_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), *paths)
