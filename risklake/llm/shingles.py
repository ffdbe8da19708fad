"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

N-grams are ordered by how many documents are estimated to have them, rare ones
first. Two similar sets must share one of their first n-grams in this order, so
only those are grouped to find candidates. To verify them the order is cut into
fragments of equal weight: the overlap of a pair is counted in each fragment by
itself and summed per pair.

Documents with equal sets are one node. Before pairs are listed, every node is
compared with one leader among those it shares rare n-grams with; groups of near
copies so become components in a few comparisons each. Then all candidate pairs
between different components are verified: no link between them is lost, and the
pairs within a component, which could not change it, are never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.llm.components import components
from risklake.llm.scratch import dropped, kept
from risklake.llm.sketch import Sketch, marks, merged, only
from risklake.llm.words import Texts, by_arrow, mixed, text_chunks, window_sums

WIDTH = 1 << 22
WANTED_WIDTH = 1 << 23
FRAGMENTS = 4
LEADER_ROUNDS = 1
_EST_BITS = 20


def shingle_set(texts: Texts, i: int, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of text i; all its words if they are fewer."""
    words = texts.of(i)
    if not len(words):
        return words
    k = min(n, len(words))
    return np.unique(mixed(window_sums(words, k) + np.uint64(k)))


def _name(shingles: np.ndarray) -> int:
    """64 bits that name a set, never 0."""
    return (xxhash.xxh3_64_intdigest(shingles.tobytes()) >> 1) or 1


def ranked(shingles: np.ndarray, sketch: Sketch) -> np.ndarray:
    """Position of each n-gram in the global order: estimated count, then hash."""
    rarity = np.minimum(sketch.estimate(shingles), (1 << _EST_BITS) - 1).astype(np.uint64)
    return (rarity << np.uint64(64 - _EST_BITS)) | (shingles >> np.uint64(_EST_BITS))


def cuts(sketch: Sketch, fragments: int) -> np.ndarray:
    """Positions that cut the global order into fragments of about equal weight."""
    values, cells = np.unique(np.minimum(sketch.cells, (1 << _EST_BITS) - 1), return_counts=True)
    weight = np.cumsum(values.astype(np.float64) * cells)
    wanted = weight[-1] * np.arange(1, fragments) / fragments
    at = np.minimum(np.searchsorted(weight, wanted), len(values) - 1)
    below = np.where(at > 0, weight[np.maximum(at - 1, 0)], 0.0)
    part = (wanted - below) / np.maximum(weight[at] - below, 1.0)
    inner = np.minimum(part, 0.999999) * float(1 << (64 - _EST_BITS))
    return (values[at].astype(np.uint64) << np.uint64(64 - _EST_BITS)) | inner.astype(np.uint64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc", "tag", F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _surveyed(docs: DataFrame, n: int, width: int) -> DataFrame:
    """Per document the name and size of its set; per task the blocks of its n-gram counts."""
    schema = pa.schema(
        [("doc", pa.int64()), ("tag", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("block", pa.int32()), ("cells", pa.binary())]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = Sketch(width, 1, "uint32"), set()
        for part, texts in text_chunks(batches, "text", lower=True):
            nodes, sizes, found = [], [], []
            for i in range(len(part)):
                shingles = shingle_set(texts, i, n)
                sizes.append(len(shingles))
                nodes.append(_name(shingles) if len(shingles) else 0)
                if len(shingles) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    found.append(shingles)
            if found:
                sketch.add(np.concatenate(found))
            none = pa.nulls(len(part))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc"), part.column("tag"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 none.cast(pa.int32()), none.cast(pa.binary())], schema=schema,
            )
        for k, cells in sketch.blocks():
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, f.type) for f in list(schema)[:4]), pa.array([k], pa.int32()), pa.array([cells], pa.binary())],
                schema=schema,
            )

    return by_arrow(_texts(docs), task, "doc long, tag long, node long, size long, block int, cells binary")


def _prefixes(docs: DataFrame, n: int, share: Fraction, shared: Broadcast) -> DataFrame:
    """First n-grams of each set in the global order of a sent sketch: all that a similar set could share first."""
    schema = pa.schema([("token", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("pos", pa.int32())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = shared.value, set()
        for part, texts in text_chunks(batches, "text", lower=True):
            out = []
            for i in range(len(part)):
                shingles = shingle_set(texts, i, n)
                size = len(shingles)
                if not size or (node := _name(shingles)) in seen:
                    continue
                seen.add(node)
                k = size - math.ceil(share * size) + 1
                first = shingles[np.argsort(ranked(shingles, sketch), kind="stable")[:k]]
                out.append((first.view(np.int64), np.full(k, node), np.full(k, size, np.int32), np.arange(k, dtype=np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([np.concatenate(x) for x in zip(*out, strict=True)], schema=schema)

    return by_arrow(_texts(docs), task, "token long, node long, size int, pos int")


def _segments(docs: DataFrame, n: int, order: Broadcast, marked: Broadcast, bounds: np.ndarray) -> DataFrame:
    """Sets of the wanted nodes cut into fragments: (node, fragment, tokens)."""
    schema = pa.schema([("node", pa.int64()), ("fragment", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, wanted, seen = order.value, marked.value, set()
        for part, texts in text_chunks(batches, "text", lower=True):
            nodes, which, tokens = [], [], []
            docs = pc.fill_null(part.column("doc"), -1).to_numpy()
            for i, hit in enumerate(wanted.estimate(docs.view(np.uint64))):
                if not hit:
                    continue
                shingles = shingle_set(texts, i, n)
                if not len(shingles) or (node := _name(shingles)) in seen:
                    continue
                seen.add(node)
                fragment = np.searchsorted(bounds, ranked(shingles, sketch), side="right")
                for v in np.unique(fragment).tolist():
                    nodes.append(node)
                    which.append(v)
                    tokens.append(shingles[fragment == v].view(np.int64))
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(which, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))],
                    schema=schema,
                )

    return by_arrow(_texts(docs), task, "node long, fragment int, tokens array<long>")


class JaccardJoin:
    """The join over one table (doc, tag, text); ``share`` is the least similarity."""

    def __init__(self, docs: DataFrame, n: int, share: Fraction, width: int = WIDTH, fragments: int = FRAGMENTS):
        self.docs, self.n, self.share, self.fragments = docs, n, share, fragments
        survey = kept(_surveyed(docs, n, width), "shingle-survey")
        sketch = merged(only(survey, True), width, 1, "uint32")
        # Sent once; the driver keeps no copy of its own, and none is left when labels() is done.
        self.order, self.bounds = docs.sparkSession.sparkContext.broadcast(sketch), cuts(sketch, fragments)
        del sketch
        self.members = kept(only(survey, False).drop("block", "cells"), "shingle-members")
        dropped(survey)
        rows = kept(_prefixes(docs, n, share, self.order), "prefixes")
        often = rows.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
        together = rows.join(often.select("token"), "token").groupBy("token", "node").agg(
            F.first("size").alias("size"), F.first("pos").alias("pos")
        )
        self.rows = kept(together, "shared-prefixes")
        dropped(rows)

    def _may(self, a_size: Column, a_pos: Column, b_size: Column, b_pos: Column) -> Column:
        """Whether two sets whose first common n-gram has these places can be similar enough."""
        up, down = self.share.numerator, self.share.denominator
        most = F.least(a_size - a_pos, b_size - b_pos)
        return (
            (most * (up + down) >= (a_size + b_size) * up)
            & (F.least(a_size, b_size) * down >= F.greatest(a_size, b_size) * up)
        )

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b, a_size, b_size), those that are similar enough, with their overlap.

        A wanted node is cut by the row of its smallest id; should other rows cut it
        as well, the counts of a fragment are equal and the largest stands for all.
        """
        up, down = self.share.numerator, self.share.denominator
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        docs = self.members.join(ends, "node", "left_semi").groupBy("node").agg(F.coalesce(F.min("doc"), F.lit(-1)).alias("doc"))
        wanted = docs.sparkSession.sparkContext.broadcast(marks(docs, "doc", WANTED_WIDTH))
        cut = kept(_segments(self.docs, self.n, self.order, wanted, self.bounds), "segments")
        wanted.destroy()
        one = cut.repartition("node", "fragment").select(F.col("node").alias("a"), "fragment", F.col("tokens").alias("a_tokens"))
        two = cut.select(F.col("node").alias("b"), "fragment", F.col("tokens").alias("b_tokens"))
        each = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(self.fragments - 1))))
        overlap = F.size(F.array_intersect("a_tokens", "b_tokens")).cast("long")
        partial = one.join(each, ["a", "fragment"]).join(two, ["b", "fragment"])
        partial = partial.groupBy("a", "b", "a_size", "b_size", "fragment").agg(F.max(overlap).alias("part"))
        total = partial.groupBy("a", "b", "a_size", "b_size").agg(F.sum("part").alias("overlap"))
        fits = F.col("overlap") * (up + down) >= (F.col("a_size") + F.col("b_size")) * up
        out = kept(total.filter(fits).select("a", "b", "overlap"), "links")
        dropped(cut)
        return out

    def leader_pairs(self, labels: DataFrame | None, seed: int) -> DataFrame:
        """Each node with the leader it shares most rare n-grams with, if in another component.

        An n-gram's leader is the node that has the fewest rarer ones, the copy with
        the fewest edits of its own: what is similar to another copy is similar to it.
        """
        rows = self._labelled(labels)
        order = F.struct("pos", F.xxhash64("node", F.lit(seed)))
        leader = rows.groupBy("token").agg(F.min(F.struct(order.alias("o"), "node", "size", "pos", "label")).alias("l"))
        led = rows.join(leader, "token").filter(
            (F.col("label") != F.col("l.label"))
            & self._may(F.col("size"), F.col("pos"), F.col("l.size"), F.col("l.pos"))
        )
        common = led.groupBy("node", "size", F.col("l.node").alias("to"), F.col("l.size").alias("to_size")).agg(
            F.count("*").alias("n")
        )
        best = common.groupBy("node", "size").agg(F.max(F.struct("n", "to", "to_size")).alias("b"))
        # The leader, which many nodes may have, is the side that adaptive execution can split.
        return best.select(
            F.col("node").alias("a"), F.col("b.to").alias("b"), F.col("size").alias("a_size"), F.col("b.to_size").alias("b_size")
        )

    def _labelled(self, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return self.rows.withColumn("label", F.col("node"))
        return self.rows.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")

    def crossing_pairs(self, labels: DataFrame | None) -> DataFrame:
        """All candidate pairs between different components.

        The largest component that shares an n-gram is not compared with itself: one
        side of the join leaves it out, so a group of near copies meets only others.
        """
        rows = kept(self._labelled(labels), "labelled")
        per = rows.groupBy("token", "label").agg(F.count("*").alias("n"))
        main = per.groupBy("token").agg(F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("labels"))
        mixed_tokens = main.filter("labels > 1").select("token", F.col("m.label").alias("main"))
        there = rows.join(mixed_tokens, "token")
        x = there.filter("label != main").select(
            "token", "main", F.col("node").alias("x"), F.col("size").alias("x_size"), F.col("pos").alias("x_pos"), F.col("label").alias("x_label")
        )
        y = there.select(
            "token", F.col("node").alias("y"), F.col("size").alias("y_size"), F.col("pos").alias("y_pos"), F.col("label").alias("y_label")
        )
        met = x.join(y, "token").filter(
            (F.col("x_label") != F.col("y_label"))
            & ((F.col("y_label") == F.col("main")) | (F.col("x") < F.col("y")))
            & self._may(F.col("x_size"), F.col("x_pos"), F.col("y_size"), F.col("y_pos"))
        )
        first = F.col("x") < F.col("y")
        return met.select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
            F.when(first, F.col("x_size")).otherwise(F.col("y_size")).alias("a_size"),
            F.when(first, F.col("y_size")).otherwise(F.col("x_size")).alias("b_size"),
        ).distinct()

    def labels(self, leader_rounds: int = LEADER_ROUNDS) -> DataFrame:
        """(node, component) of every node with a link; a component's name is its smallest node."""
        links, labels = None, None
        for k in range(leader_rounds + 1):
            pairs = self.crossing_pairs(labels) if k == leader_rounds else self.leader_pairs(labels, k)
            found = self.verified(kept(pairs, "pairs"))
            links = found if links is None else links.unionByName(found)
            labels = kept(components(links), "labels")
        self.order.destroy()
        return labels


def _grouped(docs: DataFrame, n: int, share: Fraction, doc_id: str, text: str) -> DataFrame:
    """Per row: doc, tag of its text, size of its set and its component, NULL without shingles."""
    given = docs.select(
        F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("tag"), F.col(text).alias("text")
    )
    join = JaccardJoin(given, n, share)
    return join.members.join(join.labels(), "node", "left").withColumn(
        "component", F.when(F.col("size") > 0, F.coalesce("component", "node"))
    )


def similar_groups(
    docs: DataFrame, n: int = 5, share: Fraction = Fraction(4, 5), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, the smallest id reachable by links.

    Two documents link when their sets of distinct n-word shingles (A-Z lower-cased)
    have a Jaccard similarity of ``share`` or more. A text with fewer words is one
    shingle. Empty and NULL texts have none and link with nothing. Every row has a
    result: rows that share an id are rows of their own, and a component's name is
    NULL only if all its ids are. An empty table has an empty result; columns other
    than id and text are ignored.
    """
    rows = _grouped(docs, n, share, doc_id, text)
    least = rows.filter("size > 0").groupBy("component").agg(F.min("doc").alias("component_id"))
    return rows.join(least, "component", "left").select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, n: int = 5, share: Fraction = Fraction(4, 5), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of every component: the one with the smallest id, NULL ids last.

    Rows without shingles all stay. Of equal rows one stays.
    """
    rows = _grouped(docs, n, share, doc_id, text)
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "tag")
    chosen = rows.filter("size > 0").groupBy("component").agg(F.min(order).alias("o")).select("o.doc", "o.tag")
    times = rows.filter("size > 0").groupBy("doc", "tag").agg(F.count("*").alias("times"))
    times = times.select(F.col("doc").alias("t_doc"), F.col("tag").alias("t_tag"), "times")
    chosen = chosen.join(times, chosen.doc.eqNullSafe(F.col("t_doc")) & (chosen.tag == F.col("t_tag")))
    bare = rows.filter("size = 0").select("doc", "tag", F.lit(1).cast("long").alias("times")).distinct()
    keep = kept(chosen.select("doc", "tag", "times").unionByName(bare), "kept-documents").select(
        F.col("doc").alias("_ng_doc"), F.col("tag").alias("_ng_tag"), F.col("times").alias("_ng_times")
    )
    named = docs.withColumns({"_ng_id": F.col(doc_id).cast("long"), "_ng_text": F.xxhash64(text)})
    # Ids and tags are hashed, so that whole texts are not sorted to meet them.
    left = named.join(
        keep.hint("shuffle_hash"), F.col("_ng_id").eqNullSafe(F.col("_ng_doc")) & (F.col("_ng_text") == F.col("_ng_tag"))
    )
    once = left.filter("_ng_times = 1").select(*docs.columns)
    if keep.filter("_ng_times > 1").isEmpty():
        return once
    more = left.filter("_ng_times > 1").dropDuplicates(["_ng_id", "_ng_text"]).select(*docs.columns)
    return once.unionByName(more)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar_groups(docs, n=4, share=Fraction(85, 100))


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[p + 1 : p + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(greatest(len(words) - 3, 1))) AS p FROM w WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes USING (doc_id) GROUP BY r.doc_id
"""
