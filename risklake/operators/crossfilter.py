"""Filter helpers for panels that share one set of selectors."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_DIMENSIONS = ("channel", "merchant_category", "segment", "periodo_dia", "month")


def condition(flt: Mapping[str, object], ignore: Collection[str] = ()) -> Column:
    unknown = set(flt) - set(FILTER_DIMENSIONS)
    if unknown:
        raise ValueError(f"unknown filter dimensions: {sorted(unknown)}")
    cond = F.lit(True)
    for dim, value in flt.items():
        if dim not in ignore:
            cond = cond & (F.col(dim) == F.lit(value))
    return cond


def apply_filters(
    df: DataFrame, flt: Mapping[str, object], ignore: Collection[str] = ()
) -> DataFrame:
    """AND of equality filters; a panel may ignore the dimension it displays."""
    return df.where(condition(flt, ignore))
