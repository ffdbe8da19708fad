"""Incremental loading by high-water mark, from files or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def high_water_mark(target: DataFrame, ts: str) -> str | None:
    """Latest loaded instant as text; a single value, read to let the source prune.

    Text keeps it free of the zone of the process that reads it. With year/month
    partitions the latest one is found from partition values alone and only its
    files are opened.
    """
    if {"year", "month"} <= set(target.columns):
        last = target.agg(F.max(F.struct("year", "month"))).first()[0]
        if last is None or last[0] is None:
            return None
        target = target.where((F.col("year") == last[0]) & (F.col("month") == last[1]))
    return target.agg(F.max(ts).cast("string")).first()[0]


def incremental(src: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Source rows that the target does not have yet.

    Rows later than the mark, the latest loaded instant, are new. Rows at the mark,
    and rows without an instant, are new as often as the source has them more often
    than the target. The mark goes into the filter as a literal of the column's
    type, so that it reaches the scan (or the remote database) as a pushed-down
    predicate; when the source carries year/month partitions, earlier ones are
    skipped as well.
    """
    mark = high_water_mark(target, ts)
    without = _surplus(src.where(F.col(ts).isNull()), target.where(F.col(ts).isNull()))
    if mark is None:
        return src.where(F.col(ts).isNotNull()).unionByName(without)
    instant = F.lit(mark).cast(src.schema[ts].dataType)
    later, tied = F.col(ts) > instant, F.col(ts) == instant
    if {"year", "month"} <= set(src.columns):
        month = (F.col("year"), F.col("month"))
        at = (F.year(instant), F.month(instant))
        later = later & ((month[0] > at[0]) | ((month[0] == at[0]) & (month[1] >= at[1])))
        tied = tied & (month[0] == at[0]) & (month[1] == at[1])
    known = target.where(F.col(ts) == instant)
    return src.where(later).unionByName(_surplus(src.where(tied), known)).unionByName(without)


def _surplus(src: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of ``src`` beyond those that ``target`` has equal ones for."""
    return src.exceptAll(target.select(*src.columns))


def jdbc_source(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str,
    lower: int,
    upper: int,
    readers: int = 4,
    **properties: str,
) -> DataFrame:
    """Parallel range-split read of a relational table."""
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=readers,
        properties=properties,
    )
