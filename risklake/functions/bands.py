"""Calendar labels and value bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from risklake.config import WEEKDAYS


def band(value: Column, edges) -> Column:
    """Label of the first band whose upper edge exceeds the value."""
    *bounded, (_, last) = edges
    chain = reduce(
        lambda acc, e: acc.when(value < e[0], F.lit(e[1])),
        bounded[1:],
        F.when(value < bounded[0][0], F.lit(bounded[0][1])),
    )
    return chain.otherwise(F.lit(last))


def weekday_number(ts: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return (F.weekday(ts) + 1).cast("int")


def weekday_label(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), weekday_number(ts))
