"""Fraud labels that arrive after the transaction was loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.session import written


def latest_labels(labels: DataFrame) -> DataFrame:
    """The most recent label per transaction; corrections may follow each other."""
    return labels.groupBy("transaction_id").agg(F.max_by("is_fraud", "rotulado_em").alias("_rotulo"))


def apply_late_labels(silver: DataFrame, labels: DataFrame) -> DataFrame:
    """Silver rows of the affected months only, with their latest labels.

    The result feeds a dynamic partition overwrite, so months without a changed
    label are not rewritten. Labels that carry the year and month of their
    transaction prune the reads of Silver to those months; only labels that found no
    row there, or name no month, are looked up in the rest by id.
    """
    there, latest = _labelled_months(silver, labels)
    touched = there.select("transaction_id", "year", "month").join(latest.select("transaction_id"), "transaction_id")
    months = touched.select("year", "month").distinct()
    columns = [
        F.coalesce("_rotulo", "is_fraud").alias(c) if c == "is_fraud" else F.col(c)
        for c in silver.columns
    ]
    return (
        there.join(months, ["year", "month"], "left_semi")
        .join(latest.select("transaction_id", "_rotulo"), "transaction_id", "left")
        .select(*columns)
    )


def label_changes(silver: DataFrame, labels: DataFrame) -> DataFrame:
    """Silver rows whose label changes, twice each: as they were (sinal -1) and as they are now (1).

    Only the months that hold labelled rows are read. Labels that are NULL or equal
    to Silver's change nothing; a NULL in Silver is a label like any other.
    """
    there, latest = _labelled_months(silver, labels)
    changed = there.join(latest, "transaction_id").where("_rotulo IS NOT NULL AND NOT (_rotulo <=> is_fraud)")
    sides = F.array(
        F.struct(F.lit(-1).alias("sinal"), F.col("is_fraud").alias("_lado")),
        F.struct(F.lit(1).alias("sinal"), F.col("_rotulo").alias("_lado")),
    )
    columns = [F.col("_lado").alias(c) if c == "is_fraud" else F.col(c) for c in silver.columns]
    return changed.select("*", F.inline(sides)).select(*columns, "sinal")


def _labelled_months(silver: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver's months that hold labelled rows (all months where labels name none), and the latest labels."""
    latest = written(latest_labels(labels), "rotulos")
    dated = {"year", "month"} <= set(labels.columns)
    return (silver.where(_found_months(silver, labels, latest)) if dated else silver), latest


def _found_months(silver: DataFrame, labels: DataFrame, latest: DataFrame) -> Column:
    """Condition on the calendar months that hold rows of the labels, a short list that prunes folders."""
    named = _in_months(labels.select("year", "month"))
    near = silver.where(named).select("transaction_id")
    lost = latest.select("transaction_id").join(near, "transaction_id", "left_anti")
    rest = silver.where(~named).join(lost, "transaction_id", "left_semi") if not lost.isEmpty() else None
    return named if rest is None else named | _in_months(rest.select("year", "month"))


def _in_months(dates: DataFrame) -> Column:
    wanted = F.lit(False)
    for r in dates.distinct().where("year IS NOT NULL AND month IS NOT NULL").collect():
        wanted = wanted | ((F.col("year") == r.year) & (F.col("month") == r.month))
    return wanted
