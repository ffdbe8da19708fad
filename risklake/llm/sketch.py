"""Count sketches of a given size: one per task, merged by block, broadcast once.

An estimate is never below the true count (up to the highest a counter holds). More data only raises
the estimates.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept
from risklake.llm.words import mixed

BLOCK = 1 << 16
FETCHED = 1 << 23


class Sketch:
    """``depth`` rows of ``width`` saturating counters (both powers of two)."""

    def __init__(self, width: int, depth: int = 1, kind: str = "uint8"):
        self.width, self.depth, self.kind = width, depth, np.dtype(kind)
        self.cells = np.zeros(width * depth, self.kind)

    def _cells_of(self, hashes: np.ndarray, row: int) -> np.ndarray:
        spread = mixed(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % (1 << 64)))
        return (spread & np.uint64(self.width - 1)).astype(np.int64) + row * self.width

    def add(self, hashes: np.ndarray) -> None:
        top = np.iinfo(self.kind).max
        for row in range(self.depth):
            cells, n = np.unique(self._cells_of(hashes, row), return_counts=True)
            self.cells[cells] = np.minimum(self.cells[cells].astype(np.int64) + n, top).astype(self.kind)

    def estimate(self, hashes: np.ndarray) -> np.ndarray:
        found = self.cells[self._cells_of(hashes, 0)]
        for row in range(1, self.depth):
            found = np.minimum(found, self.cells[self._cells_of(hashes, row)])
        return found

    def blocks(self) -> Iterator[tuple[int, bytes]]:
        """Compressed blocks that have counts."""
        size = min(BLOCK, len(self.cells))
        for k, cells in enumerate(self.cells.reshape(-1, size)):
            if cells.any():
                yield k, zlib.compress(cells.tobytes(), 1)

    def add_block(self, k: int, data: bytes) -> None:
        size, top = min(BLOCK, len(self.cells)), np.iinfo(self.kind).max
        part = self.cells[k * size : (k + 1) * size]
        more = np.frombuffer(zlib.decompress(data), self.kind)
        part[:] = np.minimum(part.astype(np.int64) + more, top).astype(self.kind)


class SmallSketch(Sketch):
    """Counters up to 3 in two bits each, for telling one from more; width is 4 at least."""

    def __init__(self, width: int, depth: int = 1):
        super().__init__(4, 1)
        self.width, self.depth = width, depth
        self.cells = np.zeros(width * depth // 4, np.uint8)

    def _read(self, at: np.ndarray) -> np.ndarray:
        return (self.cells[at >> 2] >> ((at & 3) * 2).astype(np.uint8)) & 3

    def add(self, hashes: np.ndarray) -> None:
        for row in range(self.depth):
            at, n = np.unique(self._cells_of(hashes, row), return_counts=True)
            have = self._read(at)
            more = np.minimum(have + n, 3).astype(np.uint8) - have
            # Cells are distinct and no field passes 3, so bytes do not overflow.
            np.add.at(self.cells, at >> 2, more << ((at & 3) * 2).astype(np.uint8))

    def estimate(self, hashes: np.ndarray) -> np.ndarray:
        found = self._read(self._cells_of(hashes, 0))
        for row in range(1, self.depth):
            found = np.minimum(found, self._read(self._cells_of(hashes, row)))
        return found

    def add_block(self, k: int, data: bytes) -> None:
        size = min(BLOCK, len(self.cells))
        part, more = self.cells[k * size : (k + 1) * size], np.frombuffer(zlib.decompress(data), np.uint8)
        sums = np.zeros_like(part)
        for shift in (0, 2, 4, 6):
            sums |= np.minimum(((part >> shift) & 3) + ((more >> shift) & 3), 3) << shift
        part[:] = sums


def _fetched(rows: DataFrame, out: Sketch) -> Sketch:
    """``out`` with the merged blocks, which come to the driver some FETCHED bytes and one job at a time.

    They are merged by all tasks and written first: an iterator over the shuffle itself
    would run a job for each of its partitions, however small.
    """
    table = kept(rows, "sketch-blocks")
    for row in table.coalesce(max(out.cells.nbytes // FETCHED, 1)).toLocalIterator():
        out.add_block(row["block"], bytes(row["cells"]))
    dropped(table)
    return out


def merged_small(parts: DataFrame, width: int, depth: int) -> SmallSketch:
    """One sketch of two-bit counters from the rows (block, cells) of all tasks."""
    size = min(4 * BLOCK, width * depth)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, SmallSketch] = {}
        for batch in batches:
            for k, data in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                sums.setdefault(k, SmallSketch(size)).add_block(0, data)
        for k, s in sums.items():
            cells = pa.array([zlib.compress(s.cells.tobytes(), 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), cells], names=["block", "cells"])

    rows = parts.select("block", "cells").repartition("block").mapInArrow(total, "block int, cells binary")
    return _fetched(rows, SmallSketch(width, depth))


def merged(parts: DataFrame, width: int, depth: int = 1, kind: str = "uint8") -> Sketch:
    """One sketch from the rows (block, cells) of all tasks.

    Blocks are summed where the shuffle brings them together, one batch at a time;
    the driver receives the one merged sketch.
    """
    size = min(BLOCK, width * depth)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, Sketch] = {}
        for batch in batches:
            for k, data in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                sums.setdefault(k, Sketch(size, 1, kind)).add_block(0, data)
        for k, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([zlib.compress(s.cells.tobytes(), 1)], pa.binary())],
                names=["block", "cells"],
            )

    rows = parts.select("block", "cells").repartition("block").mapInArrow(total, "block int, cells binary")
    return _fetched(rows, Sketch(width, depth, kind))


def marks(rows: DataFrame, column: str, width: int, depth: int = 1) -> Sketch:
    """A sketch of the values of a column of longs: which may be there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Sketch(width, depth)
        for batch in batches:
            found.add(batch.column(0).to_numpy().view(np.uint64))
        for k, cells in found.blocks():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([cells], pa.binary())], names=["block", "cells"])

    return merged(rows.select(column).mapInArrow(task, "block int, cells binary"), width, depth)


def only(parts: DataFrame, block: bool) -> DataFrame:
    """Of a table that holds both, the rows with sketch blocks or the others."""
    return parts.filter(F.col("block").isNotNull() if block else F.col("block").isNull())
