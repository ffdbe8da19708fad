"""Words of whole texts as numpy arrays.

A word is a run of bytes other than space and the controls 9 to 13. All hashing
is a function of the bytes alone, so every task and every rerun agrees.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
ARROW_ROWS = 512
CHUNK_BYTES = 1 << 20

_M = 0x9E3779B97F4A7C15
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Everything but letters, digits and the bytes of other alphabets parts plain words.
NOT_PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_count(text: Column) -> Column:
    """Number of words, 0 for NULL, without Python."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_arrow(df: DataFrame, task, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of few rows: whole texts may be very long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(task, schema)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int, base: int = _M) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i up to n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n + 1:
        size = max(n + 1, CHUNK_BYTES + CHUNK_BYTES // 4)
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= CHUNK_BYTES * 8:
            _POWERS[base] = have
    return have


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def window_sums(values: np.ndarray, k: int, base: int = _M) -> np.ndarray:
    """Polynomial hashes of all windows of k consecutive values."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(n, base)
    sums = prefix_sums(values * up[:n])
    return (sums[k:] - sums[:-k]) * down[: n - k + 1]


class Texts:
    """Words of a few texts: ``hashes`` of all words, ``first[i]:first[i+1]`` those of text i.

    ``starts`` and ``ends`` are byte positions in ``data``, the texts joined by a space.
    """

    def __init__(self, texts: list[bytes], blank: np.ndarray = _BLANK):
        self.data = b" ".join(texts) + b" "
        flat = np.frombuffer(self.data, np.uint8)
        inside = np.zeros(len(flat) + 2, np.int8)
        inside[1:-1] = ~blank[flat]
        edges = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
        self.text_ends = offsets[1:]
        self.first = np.searchsorted(self.starts, offsets)
        up, down = powers(len(flat))
        sums = prefix_sums(_BYTE_CODES[flat] * up[: len(flat)])
        lengths = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts] + lengths)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chunks(lengths: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about CHUNK_BYTES each, or one longer row."""
    start, held, end = 0, 0, 0
    for end, n in enumerate(lengths):
        if held and held + n > CHUNK_BYTES:
            yield start, end
            start, held = end, 0
        held += n + 1
    if held:
        yield start, end + 1


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, lower: bool = False, blank: np.ndarray = _BLANK
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches with the words of their binary text column (NULL: none)."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(column).to_pylist()]
        if lower:
            texts = [t.lower() for t in texts]
        for a, b in chunks(map(len, texts)):
            yield batch.slice(a, b - a), Texts(texts[a:b], blank)
