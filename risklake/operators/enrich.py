"""Silver derivations and dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.config import CLEAN_COLUMNS, CREDIT_BANDS, PERIODS, RISK_BANDS
from risklake.functions.bands import band, weekday_label, weekday_number


def silver(bronze: DataFrame) -> DataFrame:
    """Valid transactions plus calendar, period and score-band columns."""
    ts = F.col("ts")
    return bronze.select(
        *CLEAN_COLUMNS,
        ts.cast("date").alias("data"),
        "year",
        "month",
        F.hour(ts).alias("hora"),
        weekday_number(ts).alias("dia_semana_num"),
        weekday_label(ts).alias("dia_semana"),
        band(F.hour(ts), PERIODS).alias("periodo_dia"),
        band(F.col("credit_score"), CREDIT_BANDS).alias("faixa_credit_score"),
        band(F.col("risk_score"), RISK_BANDS).alias("faixa_risk_score"),
        (F.col("status") == "declined").alias("recusada"),
    )


def enrich_customer(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join on customer_id: no transaction is lost to a missing customer.

    No broadcast is forced: the planner broadcasts the customers only while
    they measure under the session threshold; beyond it, adaptive execution
    splits a customer that owns a large share of the rows.
    """
    return facts.join(customers, "customer_id", "left")


def orphans(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions whose customer is not registered, counted per customer.

    Facts are counted per customer before the anti join, which therefore moves
    one row per customer.
    """
    return (
        facts.groupBy("customer_id")
        .agg(F.count("*").alias("transacoes"))
        .join(customers.select("customer_id"), "customer_id", "left_anti")
    )
