"""Rates over time: rolling windows, month over month, streaks, past-only history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risklake.functions.numeric import percent, ratio, round_half
from risklake.session import written


def rolling_rate(daily: DataFrame, series: Sequence[str] = (), days: int = 7) -> DataFrame:
    """Ratio of sums over the current and previous present days; NULL until full.

    The daily mart is first summed to one row per day and series; each window
    partition then holds at most the number of calendar days.
    """
    per_day = daily.groupBy(*series, "data").agg(
        F.sum("transacoes").alias("transacoes"), F.sum("fraudes").alias("fraudes")
    )
    line = Window.partitionBy(*series).orderBy("data")
    frame = line.rowsBetween(-(days - 1), 0)
    full = F.row_number().over(line) >= days
    rate = percent(F.sum("fraudes").over(frame), F.sum("transacoes").over(frame), 4)
    return per_day.select(
        *series, "data", "transacoes", "fraudes", F.when(full, rate).alias("taxa_movel_pct")
    )


def month_over_month(cube: DataFrame) -> DataFrame:
    """Monthly rate beside the previous present month's."""
    months = cube.groupBy("year", "month").agg(
        F.sum("transacoes").alias("transacoes"), F.sum("fraudes").alias("fraudes")
    )
    line = Window.orderBy("year", "month")
    rate = percent(F.col("fraudes"), F.col("transacoes"), 4)
    with_rate = months.select("*", rate.alias("taxa_pct"))
    previous = F.lag("taxa_pct").over(line)
    return with_rate.select(
        "*",
        previous.alias("taxa_anterior_pct"),
        round_half(F.col("taxa_pct") - previous, 4).alias("variacao_pp"),
    )


def weeks_above(silver: DataFrame, dims: Sequence[str], weeks: int = 3) -> DataFrame:
    """Runs of consecutive weeks in which a combination exceeds the overall rate.

    Weekly counts are aggregated once and written, since both the overall rate
    and the runs read them; the runs are found per combination, over as many
    rows as there are weeks.
    """
    week = F.date_trunc("week", "data").cast("date").alias("semana")
    weekly = written(
        silver.groupBy(*dims, week).agg(
            F.count("*").alias("n"), F.count_if("is_fraud").alias("f")
        ),
        "semanas",
    )
    overall = weekly.agg(ratio(F.sum("f"), F.sum("n")).alias("t")).scalar()
    above = weekly.where(ratio(F.col("f"), F.col("n")) > overall)
    position = F.row_number().over(Window.partitionBy(*dims).orderBy("semana"))
    # Within a run of adjacent weeks, week minus position is constant.
    island = above.select("*", F.date_sub("semana", position * 7).alias("_ilha"))
    return (
        island
        .groupBy(*dims, "_ilha")
        .agg(
            F.min("semana").alias("inicio"),
            F.max("semana").alias("fim"),
            F.count("*").alias("semanas"),
            F.sum("n").alias("transacoes"),
            F.sum("f").alias("fraudes"),
        )
        .where(F.col("semanas") >= weeks)
        .drop("_ilha")
    )


def customer_history(silver: DataFrame) -> DataFrame:
    """Each transaction with its customer's strictly earlier activity.

    Simultaneous transactions do not see each other. A customer may own a large
    share of the rows, so nothing is accumulated row by row: rows shrink to one
    per customer and instant, instants accumulate within a customer's hour, and
    hours are shifted by the sums of the hours before. A window partition thus
    holds one hour of a customer's instants, or one customer's active hours.
    """
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    instants = silver.groupBy("customer_id", hour.alias("_h"), "ts").agg(
        F.count("*").alias("_n"), F.count_if("is_fraud").alias("_f")
    )
    hours = instants.groupBy("customer_id", "_h").agg(
        F.sum("_n").alias("_hn"), F.sum("_f").alias("_hf")
    )
    past_hours = _earlier(["customer_id"], "_h")
    past_instants = _earlier(["customer_id", "_h"], "ts")
    offsets = hours.select(
        "customer_id",
        "_h",
        _sum_or_zero("_hn", past_hours).alias("_on"),
        _sum_or_zero("_hf", past_hours).alias("_of"),
    )
    history = (
        instants.select(
            "customer_id",
            "_h",
            "ts",
            _sum_or_zero("_n", past_instants).alias("_wn"),
            _sum_or_zero("_f", past_instants).alias("_wf"),
        )
        .join(offsets, ["customer_id", "_h"])
        .select(
            "customer_id",
            "ts",
            (F.col("_on") + F.col("_wn")).alias("transacoes_previas"),
            (F.col("_of") + F.col("_wf")).alias("fraudes_previas"),
        )
    )
    return silver.select("transaction_id", "customer_id", "ts").join(
        history, ["customer_id", "ts"]
    )


def _earlier(keys: list[str], order: str):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_or_zero(column: str, window):
    return F.coalesce(F.sum(column).over(window), F.lit(0))
