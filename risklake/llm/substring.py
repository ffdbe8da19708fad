"""Substring dedup: a count-min sketch picks the windows that may repeat, a second pass groups those exactly.

A window is 50 consecutive words. Its anchor is the smallest hash among the
26-word runs it starts with, ends with and holds between: equal windows have equal
anchors, and neighbouring windows mostly share one, so about one anchor stands for
13 windows. Tasks count anchors, once in a document, in sketches whose size follows
from the bytes of the texts; beyond a stated size the anchors are counted in several
passes, each over a part of them by hash. The merged count of a window's anchor is never below the number of documents with
that window. The second pass groups what is estimated in two documents or more
exactly: first the anchors, then the windows that hold a repeated anchor, by 96
bits of hash. The first document of a group of windows keeps it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept
from risklake.llm.sketch import Sketch, SmallSketch, marks, merged_small, only
from risklake.llm.words import by_arrow, mixed, text_chunks, window_sums

WINDOW = 50
#: Rows of the sketch, cells in a row for each anchor expected, and texts' bytes for an anchor.
DEPTH, CELLS_FOR_ANCHOR, BYTES_FOR_ANCHOR = 3, 4, 78
#: Cells in a row of one pass, of two bits each (384 MB in all rows).
MOST_WIDTH = 1 << 29
#: Bound of each of two rows of marks for repeated anchors; beyond it marks tell less apart.
MOST_CELLS = 1 << 25
RESULTS = ("n_words", "n_removed", "kept")
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def sliding_least(values: np.ndarray, k: int) -> np.ndarray:
    """Least of each k consecutive values, by doubling."""
    span = 1
    while span * 2 <= k:
        values, span = np.minimum(values[:-span], values[span:]), span * 2
    rest = k - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(words: np.ndarray, window: int) -> np.ndarray:
    """Anchor of each window of the word hashes."""
    run = window // 2 + 1
    return sliding_least(mixed(window_sums(words, run)), window - run + 1)


def _first_of_its_text(seen: dict[int, int], text: int, doc: int) -> bool:
    """False where this task has met the same text under an id as small."""
    if doc >= seen.get(text, doc + 1):
        return False
    seen[text] = doc
    return True


def _tag(text: Column) -> Column:
    """Names a text among those of one id."""
    return F.xxhash64(text).bitwiseAND(0xFFFFFF).cast("int")


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Ids, whole texts as bytes, and a hash that names the text."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        _tag(F.col(text)).alias("tag"),
    )


def _part(hashes: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The anchors of one pass."""
    return hashes if parts == 1 else hashes[hashes % np.uint64(parts) == part]


def _sized(docs: DataFrame) -> tuple[int, int]:
    """Width of the sketch and number of passes for texts of this size."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    wanted = 1 << max(18, (CELLS_FOR_ANCHOR * size // BYTES_FOR_ANCHOR).bit_length())
    return min(wanted, MOST_WIDTH), max(1, wanted // MOST_WIDTH)


def _surveyed(docs: DataFrame, window: int, width: int, depth: int, number: int, parts: int) -> DataFrame:
    """Per document its word count and a digest of its words; per task the blocks of its sketch."""
    schema = pa.schema(
        [("doc", pa.int64()), ("tag", pa.int32()), ("n_words", pa.int64()), ("digest", pa.binary()), ("block", pa.int32()), ("cells", pa.binary())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = SmallSketch(width, depth), {}
        for part, texts in text_chunks(batches, "text"):
            ids, counts = part.column("doc").to_pylist(), texts.counts().tolist()
            digests, found = [], []
            for i, doc in enumerate(ids):
                words = texts.of(i)
                digests.append(xxhash.xxh3_128_digest(words.tobytes()))
                if doc is None or len(words) < window:
                    continue
                if _first_of_its_text(seen, int.from_bytes(digests[-1][:8], "little"), doc):
                    found.append(_part(np.unique(anchors(words, window)), number, parts))
            if found:
                sketch.add(np.concatenate(found))
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("tag"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 none.cast(pa.int32()), none.cast(pa.binary())], schema=schema,
            )
        for k, cells in sketch.blocks():
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, f.type) for f in list(schema)[:4]),
                 pa.array([k], pa.int32()), pa.array([cells], pa.binary())], schema=schema,
            )

    return by_arrow(docs, task, "doc long, tag int, n_words long, digest binary, block int, cells binary")


def _marked(docs: DataFrame, marked: Sketch) -> DataFrame:
    """Documents whose id may be marked."""
    shared = docs.sparkSession.sparkContext.broadcast(marked)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.fill_null(batch.column("doc"), -1).to_numpy()
            yield batch.filter(pa.array(shared.value.estimate(ids.view(np.uint64)) > 0))

    return by_arrow(docs, task, "doc long, text binary, tag int")


def _anchors(
    docs: DataFrame, sketch: Sketch, skipped: Sketch | None, window: int, number: int, parts: int
) -> DataFrame:
    """Anchors estimated in two documents or more: (anchor, doc)."""
    shared = docs.sparkSession.sparkContext.broadcast((sketch, skipped))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, skipped = shared.value
        for words in _long_documents(batches, window, skipped):
            rows = []
            for doc, _, hashes in words:
                found = _part(np.unique(anchors(hashes, window)), number, parts)
                found = found[sketch.estimate(found) >= 2]
                rows.append((found.view(np.int64), np.full(len(found), doc)))
            if rows:
                yield pa.RecordBatch.from_arrays([np.concatenate(c) for c in zip(*rows, strict=True)], names=["anchor", "doc"])

    return by_arrow(docs, task, "anchor long, doc long")


def _suspects(docs: DataFrame, repeated: Sketch, skipped: Sketch | None, window: int) -> DataFrame:
    """Windows that may hold a repeated anchor: hash, document, text and place."""
    shared = docs.sparkSession.sparkContext.broadcast((repeated, skipped))
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("doc", pa.int64()), ("place", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, skipped = shared.value
        for words in _long_documents(batches, window, skipped):
            rows = []
            for doc, tag, hashes in words:
                at = np.flatnonzero(repeated.estimate(anchors(hashes, window)))
                h1, h2 = (mixed(window_sums(hashes, window, b))[at].view(np.int64) for b in _BASES)
                h2 = (h2 >> 32).astype(np.int32)
                rows.append((h1, h2, np.full(len(at), doc), at + (tag << 32)))
            if rows:
                yield pa.RecordBatch.from_arrays([np.concatenate(c) for c in zip(*rows, strict=True)], schema=schema)

    return by_arrow(docs, task, "h1 long, h2 int, doc long, place long")


def _long_documents(batches: Iterator[pa.RecordBatch], window: int, skipped: Sketch | None):
    """Of each chunk the documents with a window that may not be skipped: id, tag, word hashes."""
    for part, texts in text_chunks(batches, "text"):
        ids = pc.fill_null(part.column("doc"), -1).to_numpy()
        there = (texts.counts() >= window) & np.asarray(part.column("doc").is_valid())
        if skipped is not None:
            there &= skipped.estimate(ids.view(np.uint64)) == 0
        tags = part.column("tag").to_pylist()
        yield [(int(ids[i]), tags[i], texts.of(i)) for i in np.flatnonzero(there)]


def repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    window: int = WINDOW, size: tuple[int, int] | None = None, depth: int = DEPTH,
) -> DataFrame:
    """Per document with something to remove: doc, tag of its text, and ``cut``.

    ``cut`` holds the places of its windows that also start in a document with a
    smaller id, NULL where the whole text is the words of such a document.
    """
    rows = _documents(docs, doc_id, text)
    width, parts = size or _sized(rows)
    survey = kept(_surveyed(rows, window, width, depth, 0, parts), "survey")
    sketch = merged_small(only(survey, True), width, depth)
    long = only(survey, False).filter((F.col("n_words") >= window) & F.col("doc").isNotNull())
    lead = long.groupBy("digest").agg(F.min("doc").alias("lead"))
    copies = kept(long.join(lead, "digest").filter("doc > lead").select("doc", "tag").distinct(), "copies")
    # Copies lose all words and have no window that their first document lacks: the passes leave
    # them out by marks on ids, and take in again what was marked by chance.
    skipped = marks(copies, "doc", _cells(copies), 2)
    again = kept(_marked(rows, skipped).join(copies, ["doc", "tag"], "left_anti"), "marked")
    passes = ((rows, skipped), (again.select(*rows.columns), None))
    found = []
    for number in range(parts):
        if number:
            more = kept(only(_surveyed(rows, window, width, depth, number, parts), True), "survey")
            sketch = merged_small(more, width, depth)
            dropped(more)
        estimated = _union(_anchors(r, sketch, skip, window, number, parts) for r, skip in passes)
        ends = estimated.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
        found.append(kept(ends.filter("lo < hi").select("anchor"), "anchors"))
    shared = _union(found)
    repeated = marks(shared, "anchor", _cells(shared), 2)
    suspects = kept(_union(_suspects(r, repeated, skip, window) for r, skip in passes), "suspects")
    first = suspects.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = kept(first.filter("first < last").drop("last"), "first-windows")
    cut = (
        suspects.join(first, ["h1", "h2"]).filter("doc > first")
        .groupBy("doc", F.shiftright("place", 32).cast("int").alias("tag"))
        .agg(F.sort_array(F.collect_list(F.col("place").bitwiseAND(0xFFFFFFFF).cast("int"))).alias("cut"))
    )
    out = kept(cut.unionByName(copies.withColumn("cut", F.lit(None).cast("array<int>"))), "cuts")
    dropped(survey, copies, again, *found, suspects, first)
    return out


def _cells(rows: DataFrame) -> int:
    """Cells that leave marks of so many rows an error of about one in a hundred, up to MOST_CELLS."""
    return min(max(1 << (8 * rows.count()).bit_length(), 1 << 20), MOST_CELLS)


def _union(parts: Iterator[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def without_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    window: int = WINDOW, size: tuple[int, int] | None = None, depth: int = DEPTH,
) -> DataFrame:
    """``docs`` with n_words, n_removed and ``kept``, the words left joined by one space.

    A word goes if a window of ``window`` words over it also starts in a document
    with a smaller id; all windows are those of the input. NULL texts have no
    words. Rows without id neither lose words nor make others lose them. Rows that
    share an id are judged each by its own text, and not against one another. An
    ``size`` fixes the cells in a row of the sketch and the number of passes, which
    else follow from the data; the result does not depend on them. An
    empty table has an empty result; columns of ``docs`` named like a result are
    replaced, all others stay.
    """
    cuts = repeated_windows(docs, doc_id, text, window, size, depth).select(
        F.col("doc").alias("_sub_doc"), F.col("tag").alias("_sub_tag"), F.lit(True).alias("_sub_any"),
        F.col("cut").alias("_sub_cut"),
    )
    others = [c for c in docs.columns if c not in RESULTS]
    given = docs.select(
        *others, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_sub_text"),
        _tag(F.col(text)).alias("_sub_own"), F.col(doc_id).cast("long").alias("_sub_id"),
    )
    joined = given.join(
        cuts, (F.col("_sub_id") == F.col("_sub_doc")) & (F.col("_sub_own") == F.col("_sub_tag")), "left"
    ).select(*others, "_sub_text", "_sub_any", "_sub_cut")
    schema = docs.select(*others).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, left = [], [], []
            for data, some, cut in zip(
                batch.column("_sub_text").to_pylist(), batch.column("_sub_any").to_pylist(),
                batch.column("_sub_cut"), strict=True,
            ):
                words = data.split()
                n_words.append(len(words))
                if some and not cut.is_valid:
                    words = []
                elif some:
                    places = cut.values.to_numpy()
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, places, 1)
                    np.add.at(edge, places + window, -1)
                    words = list(compress(words, np.cumsum(edge[:-1]) == 0))
                n_removed.append(n_words[-1] - len(words))
                left.append(b" ".join(words))
            results = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), *results], names=[*others, *RESULTS]
            )

    return by_arrow(joined, task, schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS words
  FROM documents
),
starts AS (
  SELECT doc_id, unnest(range(len(words) - 49)) AS place FROM w WHERE len(words) >= 50
),
windows AS (
  SELECT s.doc_id, place, sha256(array_to_string(words[place + 1 : place + 50], ' ')) AS h
  FROM starts s JOIN w USING (doc_id)
),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS place
  FROM windows JOIN firsts USING (h) WHERE doc_id > first
),
each AS (
  SELECT doc_id, unnest(range(len(words))) AS place, unnest(words) AS word FROM w
),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.place) AS text, count(*) AS n
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.place = g.place
  WHERE g.doc_id IS NULL GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
