"""Exact duplicate detection without sorting or shuffling whole rows.

A row is a duplicate when an earlier row of its group exists. Ranking every
group with a window would shuffle all rows once per check and put a hot key
(many rows without an id, say) into one task. Instead, for all checks together:

1. one pass over the key columns counts rows per key hash, combined map-side;
2. the contested hashes, seen more than once, become one bitmap of up to
   ``SKETCH_BITS`` bits, a broadcast bounded at any size. Rows whose two bits are set
   are looked at further; bits shared by chance only add a group of one row;
3. each such group's first row is an aggregated minimum, again combined
   map-side, so a hot group costs no more than any other;
4. every other contested row is a duplicate: candidates and firsts are counted by
   row address (the number given at loading), unique and therefore evenly spread.

Marks meet the rows as bitmaps too, one per 32,768 addresses and check, so that
whole rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import CONTENT_KEY
from risklake.session import shuffles_dropped, written
from risklake.sources.layers import ROW_ADDRESS


class Check(NamedTuple):
    """Rows agreeing on ``key`` are one group; the first in ``order``, NULLs last, is kept."""

    key: Sequence[str]
    order: Sequence[str]


# The content key uses the source columns as delivered: ' APP ' and 'app' are
# different contents.
CHECKS: dict[str, Check] = {
    "repete_id": Check(
        ("transaction_id",),
        (
            "timestamp",
            "customer_id",
            "amount",
            "transaction_type",
            "channel",
            "merchant_category",
            "status",
            "risk_score",
            "segment",
            "credit_score",
            "is_fraud",
        ),
    ),
    "repete_conteudo": Check(
        CONTENT_KEY, ("transaction_id", "segment", "credit_score", "is_fraud")
    ),
}


#: Key hashes are counted by this many bits, which shuffle shorter than 64.
HASH_BITS = 40
#: Sketch bits per contested hash, and the most sent to the tasks (128 MB).
BITS_PER_HASH = 12
SKETCH_BITS = 1 << 30
#: Most blocks of marks sent to the tasks: 8 KB each, 537 million rows' worth.
BROADCAST_BLOCKS = 1 << 14
BLOCK_BITS = 1 << 15


def duplicate_marks(
    df: DataFrame,
    checks: Mapping[str, Check] = CHECKS,
    address: Sequence[str] = ROW_ADDRESS,
    keys_only: DataFrame | None = None,
) -> DataFrame:
    """One row per duplicate: its address and a flag per check it fails.

    NULL keys form one group. Ties on the order fall back to the row address, so
    exactly one row of every group survives. ``df`` is read several times and must be
    stored rows. ``keys_only`` may supply the same rows without addresses, so that the
    first pass reads the keys alone.
    """
    names = list(checks)
    source = df if keys_only is None else keys_only
    hashes = source.select(F.explode(F.array(*[_hash(n, checks[n]) for n in names])).alias("_h"))
    counted = hashes.groupBy("_h").agg(F.count("*").alias("_n"))
    with shuffles_dropped(df.sparkSession):
        contested = written(counted.where("_n > 1").select("_h"), "contestados")
    wanted = -(-contested.count() * BITS_PER_HASH // BLOCK_BITS)
    blocks = F.lit(max(1, min(wanted, SKETCH_BITS // BLOCK_BITS)))
    spots = F.explode(F.array(*_spots("_h", blocks))).alias("_p")
    with shuffles_dropped(df.sparkSession):
        sketch = written(_blocks(contested.select(spots, F.lit(True).alias("_v")), "_p", ["_v"]), "contestados-bits")

    def suspects(name: str, columns: Sequence[str]) -> DataFrame:
        """Rows whose hash is in the sketch: all contested ones, and a few by chance."""
        first, second = _spots("_h", blocks)
        placed = df.select(*columns, _hash(name, checks[name]).alias("_h"))
        placed = placed.select(*columns, first.alias("_p"), second.alias("_q"))
        placed = placed.withColumn("_bloco", F.bitmap_bucket_number("_p"))
        met = placed.join(F.broadcast(sketch), "_bloco")
        return met.where(_bit("_v", "_p") & _bit("_v", "_q")).select(*columns)

    # One row per suspect and one per first of a group: a suspect that is no first is a duplicate.
    sides = []
    for n in names:
        check = checks[n]
        used = list(dict.fromkeys((*check.key, *check.order, *address)))
        for side, first in ((suspects(n, address), False), (_first(suspects(n, used), check, address), True)):
            sides.append(side.select(*address, F.lit(names.index(n)).alias("_c"), F.lit(first).alias("_f")))
    place = {n: F.col("_c") == i for i, n in enumerate(names)}
    duplicate = {n: F.count_if(at & ~F.col("_f")) > F.count_if(at & F.col("_f")) for n, at in place.items()}
    return (
        reduce(DataFrame.unionByName, sides)
        .groupBy(*address)
        .agg(*[d.alias(n) for n, d in duplicate.items()])
        .where(" OR ".join(names))
    )


def _hash(name: str, check: Check) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(name), *check.key), 64 - HASH_BITS)


def _spots(hash_: str, blocks: Column) -> tuple[Column, Column]:
    """Two places of a hash in the sketch, both in one block."""
    again = F.xxhash64(hash_)
    start = F.pmod(again, blocks) * BLOCK_BITS + 1
    return tuple(start + F.shiftrightunsigned(again, n).bitwiseAND(BLOCK_BITS - 1) for n in (33, 48))


def _blocks(df: DataFrame, place: str, flags: Sequence[str]) -> DataFrame:
    """One row per 32,768 places that has any, with a bitmap per flag of the places it holds at.

    Rows are dealt by block first, so no task builds a part of every block.
    """
    rows = df.select(F.bitmap_bucket_number(place).alias("_bloco"), F.bitmap_bit_position(place).alias("_bit"), *flags)
    return (
        rows.repartition("_bloco")
        .groupBy("_bloco")
        .agg(*[F.bitmap_construct_agg(F.when(F.col(f), F.col("_bit"))).alias(f) for f in flags])
    )


def _bit(bitmap: str, place: str) -> Column:
    """Whether a block's bitmap holds the place; NULL without a block."""
    bit = F.bitmap_bit_position(place)
    byte = F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1


def _first(candidates: DataFrame, check: Check, address: Sequence[str]) -> DataFrame:
    order = [F.struct(F.col(c).isNull(), F.col(c)).alias(f"_{i}") for i, c in enumerate(check.order)]
    return (
        candidates.groupBy(*check.key)
        .agg(F.min(F.struct(*order, *address)).alias("_first"))
        .select(*[F.col(f"_first.{a}").alias(a) for a in address])
    )


def packed_marks(
    marks: DataFrame, checks: Mapping[str, Check] = CHECKS, address: Sequence[str] = ROW_ADDRESS
) -> DataFrame:
    """The marks as bitmaps, one row per block of addresses: a quarter byte per raw row."""
    (place,) = address
    return _blocks(marks, place, list(checks))


def fits_in_tasks(packed: DataFrame) -> bool:
    return packed.count() <= BROADCAST_BLOCKS


def with_packed(
    raw: DataFrame,
    packed: DataFrame,
    checks: Mapping[str, Check] = CHECKS,
    address: Sequence[str] = ROW_ADDRESS,
) -> DataFrame:
    """Raw rows plus one duplicate flag per check, from written bitmaps.

    The bitmaps are sent to the rows, which keep their order and files; only beyond
    ``BROADCAST_BLOCKS`` of them the planner may move the rows.
    """
    (place,) = address
    sent = F.broadcast(packed) if fits_in_tasks(packed) else packed
    held = sent.select("_bloco", *[F.col(n).alias(f"_em_{n}") for n in checks])
    joined = raw.withColumn("_bloco", F.bitmap_bucket_number(place)).join(held, "_bloco", "left")
    return joined.select(
        *[c for c in raw.columns if c not in address],
        *[F.coalesce(_bit(f"_em_{n}", place), F.lit(False)).alias(n) for n in checks],
    )


def with_marks(
    raw: DataFrame,
    marks: DataFrame,
    checks: Mapping[str, Check] = CHECKS,
    address: Sequence[str] = ROW_ADDRESS,
) -> DataFrame:
    """Raw rows plus one duplicate flag per check, from one row per duplicate."""
    packed = written(packed_marks(marks, checks, address), "marcas")
    return with_packed(raw, packed, checks, address)
