"""Vectors as rows: which of them take part, and their bits under random hyperplanes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vector: Column) -> Column:
    """Not NULL or empty, no NULL or non-finite component, not all zero."""
    plain = F.coalesce(vector.cast("array<double>"), F.array().cast("array<double>"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (F.size(plain) > 0) & F.forall(plain, finite) & F.exists(plain, lambda x: x != 0)


def usable_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part."""
    named = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return named.filter(F.col("id").isNotNull() & usable(F.col("vector")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def planes(seed: int, number: int, bits: int, dim: int) -> np.ndarray:
    """Random hyperplanes of one hash string; the same in every task."""
    return np.random.default_rng([seed, number]).standard_normal((dim, bits))


def hash_strings(unit: np.ndarray, hyperplanes: np.ndarray) -> np.ndarray:
    """Sides of the hyperplanes as the leading bits of unsigned 64-bit strings."""
    sides = (unit @ hyperplanes) >= 0
    bits = hyperplanes.shape[1]
    return (sides.astype(np.uint64) << np.arange(63, 63 - bits, -1, dtype=np.uint64)).sum(1, dtype=np.uint64)


def signed(keys: np.ndarray) -> np.ndarray:
    """Unsigned strings as signed longs of the same order."""
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(np.arange(0, n * d + 1, d, dtype=np.int32), rows.ravel())


def with_units(df: DataFrame) -> DataFrame:
    """``df`` with ``unit``, its column ``vector`` divided by its length.

    Components are scaled by the largest first, so that very large and very small
    ones neither overflow nor vanish.
    """
    names = df.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                rows = matrix(part.column("vector"))
                rows = rows / np.abs(rows).max(1, keepdims=True)
                rows = rows / np.sqrt((rows * rows).sum(1, keepdims=True))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), lists(rows)], names=[*names, "unit"])

    return df.mapInArrow(task, df.select("*").schema.add("unit", T.ArrayType(T.DoubleType())))
