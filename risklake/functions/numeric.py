"""Rounding, money and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(value: Column, digits: int) -> Column:
    """Round half away from zero with plain double arithmetic.

    Spark's ``round`` goes through decimals and disagrees with other engines on
    values such as 1.005; floor-based rounding is reproducible everywhere.
    """
    scale = F.lit(float(10**digits))
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale


def cents(amount: Column) -> Column:
    """Money as whole cents, so sums do not depend on row order."""
    whole = F.floor(F.abs(amount) * F.lit(100.0) + F.lit(0.5))
    return (F.signum(amount) * whole).cast("bigint")


def from_cents(total: Column) -> Column:
    return total.cast("double") / F.lit(100.0)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL on a zero or missing denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return round_half(
        F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits
    )
