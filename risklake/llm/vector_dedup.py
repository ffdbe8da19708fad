"""Embedding near-dedup by sorted projection passes.

Every pass concatenates the bits of fresh random hyperplanes to one hash string,
orders all vectors by it, and compares each with a bounded window of those behind
it and with all that share its leading bits, however many these are; a crowded
prefix is compared in blocks of bounded size. So a pass misses a pair only if a
leading bit parts it, wherever the rows crowd. Verified pairs of all passes are
united to components, whose links are counted afterwards over all their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.components import components
from risklake.llm.scratch import kept
from risklake.llm.vectors import hash_strings, matrix, planes, signed, usable_vectors, with_units

BITS = 48
WINDOW = 48
BLOCK_ROWS = 1024
CROWDED_ROWS = 4096
STRIPE = 256
LOST = 1e-3
LINKED = 0.9


def prefix_bits(n: int, window: int = WINDOW) -> float:
    """Bits that cut evenly spread rows down to half a window."""
    return max(math.log2(max(n, 2) / window), 0.0) + 1


def passes_needed(n: int, cosine: float = LINKED, window: int = WINDOW, lost: float = LOST) -> int:
    """Passes after which a pair at the least cosine has been missed with a chance of ``lost``.

    Two such vectors agree in a bit with chance 1 - angle / pi, and are compared when
    they agree in the leading bits.
    """
    met = (1 - math.acos(cosine) / math.pi) ** prefix_bits(n, window)
    return max(4, math.ceil(math.log(lost) / math.log1p(-met)))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _passes(rows: DataFrame, passes: int, seed: int) -> DataFrame:
    """Each vector once per pass with its hash string."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = matrix(batch.column("unit"))
            for p in range(passes):
                key = signed(hash_strings(unit, planes(seed, p, BITS, unit.shape[1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), p, np.int32)), pa.array(key), batch.column("id"), batch.column("unit")],
                    names=["pass", "key", "id", "unit"],
                )

    return rows.select("id", "unit").mapInArrow(task, "pass int, key long, id long, unit array<double>")


def _united(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what a symmetric matrix of links joins."""
    left, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root], waiting = False, [root]
        while waiting:
            new = np.flatnonzero(linked[waiting.pop()] & left)
            left[new] = False
            edges += [(root, int(k)) for k in new]
            waiting += new.tolist()
    return edges


def _joined(x: np.ndarray, y: np.ndarray | None, cosine: float) -> np.ndarray:
    """Pairs of places in x and y (None: in x alone) that join all that verified pairs join.

    All pairs are compared, a stripe of x at a time. Each row of y is named with one
    of its partners in the stripe; partners in the stripe that share a row with each
    other are joined directly, so the pairs do not grow with the square of a group.
    """
    pairs = [np.zeros((0, 2), np.int64)]
    for a in range(0, len(x), STRIPE):
        stripe, start = x[a : a + STRIPE], a if y is None else 0
        other = x[a:] if y is None else y
        linked = stripe @ other.T >= cosine
        if y is None:
            np.fill_diagonal(linked, True)
        many = linked.sum(0)
        there = np.flatnonzero(many)
        pairs.append(np.stack([a + linked[:, there].argmax(0), start + there], 1))
        shared = linked[:, many > 1].astype(np.float32)
        if shared.shape[1]:
            edges = _united(shared @ shared.T > 0)
            pairs.append(a + np.array(edges, np.int64).reshape(-1, 2) if y is None else _of_x(a, edges))
    return np.concatenate(pairs)


def _of_x(start: int, edges: list[tuple[int, int]]) -> np.ndarray:
    """Edges within x among pairs of x and y: places of x are given as -1 - place in the second column."""
    found = np.array(edges, np.int64).reshape(-1, 2) + start
    return np.stack([found[:, 0], -1 - found[:, 1]], 1)


def _pairs(ids: np.ndarray, others: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of joined places, without rows joined to themselves."""
    first, second = ids[joined[:, 0]], joined[:, 1]
    second = np.where(second >= 0, others[np.maximum(second, 0)], ids[np.maximum(-1 - second, 0)])
    apart = first != second
    return first[apart], second[apart]


def _prefix(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.int64(64 - bits)


def _links(ordered: DataFrame, window: int, cosine: float, bits: int, most: int) -> DataFrame:
    """Verified pairs within the windows of sorted rows, and what joins the rows of each prefix.

    Rows of one pass and prefix lie in one partition. The last rows of a batch and the
    prefix that it ends in are carried to the next; prefixes of more than ``most`` rows
    are left to ``_crowded_links``.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, ids, unit = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), None
        begun = 0  # where the rows of the prefix not yet compared begin, among the rows held

        def compared(start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
            own = slice(start, end)
            return _pairs(ids[own], ids[own], _joined(unit[own], None, cosine)) if 1 < end - start <= most else (ids[:0], ids[:0])

        for batch in batches:
            more = matrix(batch.column("unit"))
            if not len(more):
                continue
            fresh = len(number)
            number = np.append(number, batch.column("pass").to_numpy())
            keys = np.append(keys, batch.column("key").to_numpy())
            ids = np.append(ids, batch.column("id").to_numpy())
            unit = more if unit is None else np.concatenate([unit, more])
            a, b = [], []
            for step in range(1, min(window, len(ids) - 1) + 1):
                left = np.arange(max(fresh - step, 0), len(ids) - step)
                near = left[number[left] == number[left + step]]
                near = near[_cosines(unit[near], unit[near + step]) >= cosine]
                a.append(ids[near])
                b.append(ids[near + step])
            cut = _prefix(keys, bits)
            ends = begun + 1 + np.flatnonzero((np.diff(cut[begun:]) != 0) | (np.diff(number[begun:]) != 0))
            for end in ends.tolist():
                x, y = compared(begun, end)
                a.append(x)
                b.append(y)
                begun = end
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([np.minimum(a, b), np.maximum(a, b)], names=["a", "b"])
            # Of a crowded prefix only so many rows are held that it stays known as one.
            if len(ids) - begun > most + window:
                begun = len(ids) - most - window
            keep = min(begun, max(len(ids) - window, 0))
            number, keys, ids, unit, begun = number[keep:], keys[keep:], ids[keep:], unit[keep:], begun - keep
        if len(ids):
            a, b = compared(begun, len(ids))
            yield pa.RecordBatch.from_arrays([np.minimum(a, b), np.maximum(a, b)], names=["a", "b"])

    return ordered.mapInArrow(task, "a long, b long")


def _crowded_links(passed: DataFrame, cosine: float, most: int) -> DataFrame:
    """What joins the rows of prefixes of more than ``most`` rows, dealt into blocks compared two by two."""
    sizes = passed.groupBy("pass", "prefix").agg(F.count("*").alias("n")).filter(F.col("n") > most)
    sizes = kept(sizes.select("pass", "prefix", F.ceil(F.col("n") / most).cast("int").alias("blocks")), "crowded-prefixes")
    dealt = passed.join(sizes, ["pass", "prefix"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pass", "prefix", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "unit"
    )

    def task(table: pa.Table) -> pa.Table:
        own, ids, unit = table["own"].to_numpy(), table["id"].to_numpy(), matrix(table["unit"])
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
        a, b = _pairs(ids[x], ids[y], _joined(unit[x], None if i == j else unit[y], cosine))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return spread.groupBy("pass", "prefix", "i", "j").applyInArrow(task, "a long, b long")


def _block_links(rows: DataFrame, cosine: float, block_rows: int) -> DataFrame:
    """Per (component, id): weight of its links, over all pairs of the component.

    A component is dealt into blocks of about ``block_rows``; a task compares two
    blocks and adds up the weights, so no pair is ever a row.
    """
    sizes = rows.groupBy("component").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = dealt.withColumn("other", other).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "weight", "unit"
    )

    def task(table: pa.Table) -> pa.Table:
        own, weight = table["own"].to_numpy(), table["weight"].to_numpy()
        ids, unit = table["id"].to_numpy(), matrix(table["unit"])
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        x, y = np.flatnonzero(own == i), np.flatnonzero(own == j)
        linked = unit[x] @ unit[y].T >= cosine
        if i == j:
            np.fill_diagonal(linked, False)
            out = [(x, linked @ weight[y])]
        else:
            out = [(x, linked @ weight[y]), (y, linked.T @ weight[x])]
        return pa.table(
            {"id": np.concatenate([ids[k] for k, _ in out]), "links": np.concatenate([n for _, n in out]).astype(np.int64)}
        )

    counted = spread.groupBy("component", "i", "j").applyInArrow(task, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = LINKED,
    window: int = WINDOW, lost: float = LOST, seed: int = 10, block_rows: int = BLOCK_ROWS,
    crowded_rows: int = CROWDED_ROWS,
) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Vectors link from a cosine of ``cosine`` on, in double precision; equal vectors
    are compared once and count as often as they occur. NULL, zero and non-finite
    vectors link with nothing and are their own components, as are rows without id.
    Only vectors of one length are compared with each other. Rows that share an id
    are one vector if their components are equal and take part once each otherwise.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    usable = usable_vectors(vectors, vec_id, vector)
    distinct = usable.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    distinct = kept(with_units(distinct), "distinct-vectors")
    links = None
    for dim, n in distinct.groupBy(F.size("vector").alias("dim")).count().collect():
        rows = distinct.filter(F.size("vector") == dim)
        passes = passes_needed(n, cosine, window, lost)
        bits = math.floor(prefix_bits(n, window))
        passed = _passes(rows, passes, seed).withColumn("prefix", F.shiftright("key", 64 - bits))
        ordered = passed.repartitionByRange("pass", "prefix").sortWithinPartitions("pass", "key", "id").drop("prefix")
        found = _links(ordered, window, cosine, bits, crowded_rows)
        found = found.unionByName(_crowded_links(passed, cosine, crowded_rows))
        links = found if links is None else links.unionByName(found)
    if links is None:
        return _result(vectors, vec_id, vector, distinct.select("vector", "id", F.lit(0).alias("n"), F.lit(0).alias("c")))
    labels = kept(components(links), "vector-labels")
    member = distinct.join(labels, distinct.id == labels.node).select("id", "component", "weight", "unit")
    counted = _block_links(member, cosine, block_rows)
    named = (
        distinct.join(labels, distinct.id == labels.node, "left").join(counted, "id", "left")
        .select(
            "vector", "id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("component", "id").alias("c"),
        )
    )
    return _result(vectors, vec_id, vector, kept(named, "vector-results"))


def _result(vectors: DataFrame, vec_id: str, vector: str, named: DataFrame) -> DataFrame:
    """Hand the results of distinct vectors to all rows that hold them."""
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return given.join(named.select("n", "c", F.col("vector")), F.col("v") == F.col("vector"), "left").select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNull(), None).otherwise(F.coalesce("c", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_vector_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_links, min(other) AS component_id,
  vec_id = min(other) AS kept
FROM reach LEFT JOIN n ON vec_id = a GROUP BY vec_id
"""
