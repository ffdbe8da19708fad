"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree keeps all vectors sorted by a long hash string, the sides of random
hyperplanes. A query descends each tree to the vectors with its longest prefix,
then ascends all trees together, one bit at a time, until the vectors below it in
all trees reach the wanted number. These are scored exactly. A query that finds too
little even in its blocks ascends above them, to all rows if need be. Rows are first
parted into bands whose norms differ by less than a factor of two, each with trees of
its own, so that a few long vectors do not crowd the others at one pole.

A tree's sorted array is dealt by its leading bits into blocks, a crowded block by
hash into parts of bounded size; counts of prefixes add up over parts and trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from risklake.llm.scratch import kept
from risklake.llm.vectors import hash_strings, matrix, planes, signed, usable

TREES = 40
NEAREST = 20
PART_ROWS = 4096
ROUGH = 256
SEED = 1
PLACE = ("tree", "band", "block")
BELOW, WHOLE = -1, -2


def wanted_candidates(n: int, trees: int = TREES, nearest: int = NEAREST) -> int:
    """Vectors that all trees together shall offer a query; grows more slowly than the table.

    With few vectors the number lies above what one bit leaves, so that all are scored.
    """
    return max(math.ceil(64 * n**0.6), trees * 2 * (nearest + 1))


def _aligned(rows: np.ndarray, longest: float | None = None) -> np.ndarray:
    """Vectors whose angles order as the inner products do.

    Rows are scaled into the unit ball of their band and lifted onto the sphere by
    one more component; a query (no ``longest``) has none of it.
    """
    if longest is None:
        rows = rows / np.abs(rows).max(1, keepdims=True)
        rows = rows / np.sqrt((rows * rows).sum(1, keepdims=True))
        return np.concatenate([rows, np.zeros((len(rows), 1))], 1)
    rows = rows / (longest or 1.0)
    rest = np.sqrt(np.maximum(1.0 - (rows * rows).sum(1, keepdims=True), 0.0))
    return np.concatenate([rows, rest], 1)


def _block(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _keys(points: np.ndarray, tree: int) -> np.ndarray:
    return hash_strings(points, planes(SEED, tree, 64, points.shape[1]))


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64) ^ np.uint64(1 << 63)


def _ranges(keys: np.ndarray, wanted: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys that agree with the wanted ones in the leading bits begin and end."""
    below = np.where(level > 0, np.uint64(64) - np.maximum(level, 1).astype(np.uint64), np.uint64(0))
    mask = np.where(level > 0, (np.uint64(1) << below) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
    low = wanted & ~mask
    return np.searchsorted(keys, low, "left"), np.searchsorted(keys, low | mask, "right")


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up in order."""
    return np.cumsum(queries * rows, axis=1)[:, -1]


@dataclass
class Band:
    """Rows whose norms lie within a factor of two: how many, the longest, and how they are dealt."""

    n: int
    longest: float
    wanted: int
    bits: int
    #: Rows by tree and block.
    filled: np.ndarray | None = None

    def ascended(self, keys: np.ndarray) -> np.ndarray:
        """Longest prefix, up to the blocks', at which all trees offer queries enough; keys by tree and query.

        BELOW where the blocks themselves offer enough, WHOLE where the trees
        together would offer more than there are rows.
        """
        out = np.full(keys.shape[1], WHOLE)
        trees = np.arange(len(keys))[:, None]
        for level in range(self.bits + 1):
            counts = self.filled.reshape(len(keys), 1 << level, -1).sum(2)
            total = counts[trees, np.stack([_block(k, level) for k in keys])].sum(0)
            out[(total >= self.wanted) & (total < self.n)] = level
            if level == self.bits:
                out[total >= self.wanted] = BELOW
        return out


class Forest:
    """The forest over the rows (id, vector, band) of one dimension."""

    def __init__(self, rows: DataFrame, sizes: dict[int, tuple[int, float]], trees: int, nearest: int, part_rows: int):
        self.rows, self.trees, self.nearest, self.bands = rows, trees, nearest, {}
        for band, (n, longest) in sizes.items():
            wanted = wanted_candidates(n, trees, nearest)
            self.bands[band] = Band(n, longest, wanted, max(math.floor(math.log2(max(trees * n / wanted, 1))) - 1, 0))
        self.keys = kept(self._hashed(vectors=False), "forest-keys")
        counted = self.keys.groupBy("tree", "band", "block").agg(F.count("*").alias("n"))
        self.parts = kept(counted.withColumn("parts", F.ceil(F.col("n") / part_rows).cast("int")), "forest-parts")
        for x in self.bands.values():
            x.filled = np.zeros((trees, 1 << x.bits), np.int64)
        for tree, band, block, n in self.parts.select("tree", "band", "block", "n").collect():
            self.bands[band].filled[tree, block] = n
        self.parts = self.parts.drop("n")

    def _hashed(self, vectors: bool) -> DataFrame:
        """Each row once per tree: tree, band, block, key, id, and the vector if wanted."""
        kind, bands, trees = self.rows.schema["vector"].dataType.simpleString(), dict(self.bands), self.trees
        names = ["tree", "band", "block", "key", "id", *(["vector"] if vectors else [])]
        how = {band: (x.longest, x.bits) for band, x in bands.items()}

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of = batch.column("band").to_numpy()
                for band in np.unique(of).tolist():
                    part, (longest, bits) = batch.take(pa.array(np.flatnonzero(of == band))), how[band]
                    points = _aligned(matrix(part.column("vector")), longest)
                    for t in range(trees):
                        keys = _keys(points, t)
                        columns = [
                            pa.array(np.full(len(keys), t, np.int32)), pa.array(np.full(len(keys), band, np.int32)),
                            pa.array(_block(keys, bits)), pa.array(signed(keys)), part.column("id"),
                        ]
                        yield pa.RecordBatch.from_arrays(columns + ([part.column("vector")] if vectors else []), names=names)

        schema = "tree int, band int, block long, key long, id long" + (f", vector {kind}" if vectors else "")
        return self.rows.mapInArrow(task, schema)

    def _dealt(self, index: DataFrame) -> DataFrame:
        return index.join(self.parts, list(PLACE)).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")

    def _ascended(self, queries: DataFrame) -> DataFrame:
        """Per query and band the prefix length found from the blocks alone: (id, band, level)."""
        shared, trees = queries.sparkSession.sparkContext.broadcast(self.bands), self.trees

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                points = _aligned(matrix(batch.column("vector")))
                keys = np.stack([_keys(points, t) for t in range(trees)])
                for band, x in shared.value.items():
                    level = x.ascended(keys).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(np.full(len(level), band, np.int32)), pa.array(level)], names=["id", "band", "level"]
                    )

        return queries.select("id", "vector").mapInArrow(task, "id long, band int, level int")

    def _asked(self, queries: DataFrame, vectors: bool) -> DataFrame:
        """Queries (id, vector, band, level) at all parts of the blocks below their prefixes that hold rows."""
        shared, trees = queries.sparkSession.sparkContext.broadcast(self.bands), self.trees
        kind = queries.schema["vector"].dataType.simpleString()
        names = ["tree", "band", "block", "key", "id", "level", *(["vector"] if vectors else [])]

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                points = _aligned(matrix(batch.column("vector")))
                of, level = batch.column("band").to_numpy(), batch.column("level").to_numpy()
                for t in range(trees):
                    keys = _keys(points, t)
                    for band, x in shared.value.items():
                        mine = of == band
                        if t:
                            mine &= level != WHOLE
                        above = np.where(level < 0, np.where(level == WHOLE, 0, x.bits), np.minimum(level, x.bits))
                        for up in np.unique(above[mine]).tolist():
                            asked = np.flatnonzero(mine & (above == up))
                            first = _block(keys[asked], up) << (x.bits - up)
                            for step in range(1 << (x.bits - up)):
                                has = x.filled[t, first + step] > 0
                                rows, block = asked[has], first[has] + step
                                if not len(rows):
                                    continue
                                columns = [
                                    pa.array(np.full(len(rows), t, np.int32)), pa.array(np.full(len(rows), band, np.int32)),
                                    pa.array(block), pa.array(signed(keys[rows])), batch.column("id").take(pa.array(rows)),
                                    pa.array(np.maximum(level[rows], 0).astype(np.int32)),
                                ]
                                more = [batch.column("vector").take(pa.array(rows))] if vectors else []
                                yield pa.RecordBatch.from_arrays(columns + more, names=names)

        schema = "tree int, band int, block long, key long, id long, level int" + (f", vector {kind}" if vectors else "")
        asked = queries.select("id", "vector", "band", "level").mapInArrow(task, schema)
        return asked.join(self.parts, list(PLACE)).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        ).drop("parts")

    def levels(self, queries: DataFrame) -> DataFrame:
        """Per query and band the prefix length at which all trees together offer enough: (id, band, level).

        Block sizes say it for queries that find too little in their blocks; the others
        are counted within their blocks.
        """
        first = kept(self._ascended(queries), "forest-ascended")
        bits = {band: x.bits for band, x in self.bands.items()}

        def count(index: pa.Table, asked: pa.Table) -> pa.Table:
            keys, wanted = np.sort(_unsigned(index["key"])), _unsigned(asked["key"])
            counts = np.zeros((len(wanted), 65), np.int64)
            for level in range(bits[asked["band"][0].as_py()] if len(asked) else 0, 65):
                low, high = _ranges(keys, wanted, np.full(len(wanted), level))
                counts[:, level] = high - low
            return pa.table({"id": asked["id"], "band": asked["band"], "counts": pa.array(list(counts), pa.list_(pa.int64()))})

        group = (*PLACE, "part")
        below = queries.join(first.filter(F.col("level") == BELOW), "id")
        counted = (
            self._dealt(self.keys).groupBy(*group)
            .cogroup(self._asked(below, vectors=False).groupBy(*group))
            .applyInArrow(count, "id long, band int, counts array<long>")
        )
        total = counted.groupBy("id", "band").agg(F.array(*(F.sum(F.get("counts", F.lit(i))) for i in range(65))).alias("total"))
        enough = F.create_map(*(F.lit(v) for band, x in self.bands.items() for v in (band, x.wanted)))[F.col("band")]
        total = total.withColumn("enough", enough)
        found = F.array_max(F.transform("total", lambda x, i: F.when(x >= F.col("enough"), i)))
        return first.filter(F.col("level") != BELOW).unionByName(total.select("id", "band", found.cast("int").alias("level")))

    def search(self, queries: DataFrame) -> DataFrame:
        """Nearest vectors found for each query: query_id, rank, vec_id, score."""
        nearest = self.nearest
        levels = kept(self.levels(queries), "forest-levels")

        def score(index: pa.Table, asked: pa.Table) -> pa.Table:
            out = {"query_id": [], "vec_id": [], "score": []}
            if len(index) and len(asked):
                keys = _unsigned(index["key"])
                order = np.argsort(keys)
                keys, ids, rows = keys[order], index["id"].to_numpy()[order], matrix(index["vector"])[order]
                names, wanted = asked["id"].to_numpy(), matrix(asked["vector"])
                low, high = _ranges(keys, _unsigned(asked["key"]), asked["level"].to_numpy())
                for q, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
                    if q % ROUGH == 0:
                        rough = wanted[q : q + ROUGH] @ rows.T
                    own = np.arange(a, b)
                    own = own[ids[a:b] != names[q]]
                    if len(own) > nearest:
                        scores = rough[q % ROUGH, own]
                        least = np.partition(scores, len(own) - nearest)[len(own) - nearest]
                        own = own[scores >= least - 1e-9 * max(1.0, abs(least))]
                    found = _exact(np.broadcast_to(wanted[q], (len(own), wanted.shape[1])), rows[own])
                    best = np.lexsort((ids[own], -found))[:nearest]
                    out["query_id"].append(np.full(len(best), names[q]))
                    out["vec_id"].append(ids[own][best])
                    out["score"].append(found[best])
            kinds = {"query_id": np.int64, "vec_id": np.int64, "score": np.float64}
            return pa.table({c: np.concatenate(x or [np.zeros(0)]).astype(kinds[c]) for c, x in out.items()})

        group = (*PLACE, "part")
        asked = self._asked(queries.join(levels, "id"), vectors=True)
        found = (
            self._dealt(self._hashed(vectors=True)).groupBy(*group).cogroup(asked.groupBy(*group))
            .applyInArrow(score, "query_id long, vec_id long, score double")
        )
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ordered = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= nearest).select(
            "query_id", "rank", "vec_id", "score"
        )


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding",
    nearest: int = NEAREST, trees: int = TREES, part_rows: int = PART_ROWS,
) -> DataFrame:
    """The ``nearest`` other rows found for each query row, by largest inner product.

    ``is_query`` is a condition on the id column. Scores are inner products of the
    given vectors in double precision; ties go to the smaller id. A query with fewer
    other vectors gets them all. Rows without id, and vectors that are NULL, zero or
    hold NULL or non-finite components, take no part. Rows that share an id count as
    one, with the least of their vectors. Vectors meet only those of their length.
    """
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    given = vectors.select(F.col(vec_id).cast("long").alias(vec_id), F.col(vector).alias("vector"))
    whole = given.filter(F.col(vec_id).isNotNull() & usable(F.col("vector")))
    base = whole.groupBy(vec_id).agg(F.min("vector").alias("vector")).withColumn("query", is_query)
    rows = kept(base.select(F.col(vec_id).alias("id"), "vector", "query"), "ann-rows")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = rows.withColumn("norm", norm).withColumn("band", F.coalesce(F.floor(F.log2("norm")).cast("int"), F.lit(-2000)))
    sizes: dict[int, dict[int, tuple[int, float]]] = {}
    for dim, band, n, longest in rows.groupBy(F.size("vector").alias("dim"), "band").agg(F.count("*"), F.max("norm")).collect():
        sizes.setdefault(dim, {})[band] = (n, longest)
    result = None
    for dim, bands in sizes.items():
        own = rows.filter(F.col("vector").isNotNull() & (F.size("vector") == dim))
        forest = Forest(own.select("id", "vector", "band"), bands, trees, nearest, part_rows)
        found = forest.search(own.filter("query").select("id", "vector"))
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return result


def op1_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
