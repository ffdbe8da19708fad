"""Additive measures, Gold marts and the KPIs recomputed from them.

Marts store counts and sums only. Every rate is computed after aggregation, so
any mart can be re-aggregated to any coarser grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risklake.config import MARTS
from risklake.functions.numeric import cents, from_cents, percent, ratio, round_half

MEASURES = (
    "transacoes",
    "fraudes",
    "recusadas",
    "recusas_legitimas",
    "valor_total",
    "valor_fraude",
)
SCORE_SUM = "soma_credit_score"


def metrics() -> list[Column]:
    """The six additive measures over transaction rows."""
    fraud, declined = F.col("is_fraud"), F.col("recusada")
    value = cents(F.col("amount"))
    return [
        F.count("*").alias("transacoes"),
        F.count_if(fraud).alias("fraudes"),
        F.count_if(declined).alias("recusadas"),
        F.count_if(declined & ~fraud).alias("recusas_legitimas"),
        from_cents(F.sum(value)).alias("valor_total"),
        from_cents(F.sum(F.when(fraud, value).otherwise(F.lit(0)))).alias("valor_fraude"),
    ]


def additive(df: DataFrame) -> list[Column]:
    """Sums that re-aggregate a mart's measures; money is summed in cents."""
    money = {"valor_total", "valor_fraude"}
    return [
        (from_cents(F.sum(cents(F.col(m)))) if m in money else F.sum(m)).alias(m)
        for m in MEASURES
        if m in df.columns
    ]


def score_sum() -> Column:
    return F.sum("credit_score").cast("double").alias(SCORE_SUM)


def mart(silver: DataFrame, name: str) -> DataFrame:
    """One Gold mart."""
    extra = [score_sum()] if name == "gold_segmento_score" else []
    return silver.groupBy(*MARTS[name]).agg(*metrics(), *extra)


def all_marts(silver: DataFrame) -> DataFrame:
    """All marts from one scan, as grouping sets tagged with the mart name.

    Reading Silver once matters more than the fourfold row expansion: the keys
    are low-cardinality, so partial aggregation leaves a few hundred rows per
    task to shuffle whatever the volume.
    """
    dims = list(dict.fromkeys(d for keys in MARTS.values() for d in keys))
    sets = [[F.col(k) for k in keys] for keys in MARTS.values()]
    name = (
        F.when(F.grouping("data") == 0, F.lit("gold_serie_diaria"))
        .when(F.grouping("hora") == 0, F.lit("gold_perfil_horario"))
        .when(F.grouping("faixa_credit_score") == 0, F.lit("gold_segmento_score"))
        .otherwise(F.lit("gold_cubo_risco"))
    )
    return silver.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        *metrics(), score_sum(), name.alias("mart")
    )


def pick_mart(sets: DataFrame, name: str) -> DataFrame:
    extra = [SCORE_SUM] if name == "gold_segmento_score" else []
    return sets.where(F.col("mart") == name).select(*MARTS[name], *MEASURES, *extra)


def mart_deltas(changes: DataFrame) -> DataFrame:
    """What changed rows add to every mart: marts of the new rows less marts of the old.

    ``changes`` holds Silver rows with ``sinal``: -1 as they were, 1 as they are.
    """
    was, now = (all_marts(changes.where(F.col("sinal") == s)) for s in (-1, 1))
    return now.unionByName(was.withColumns({m: -F.col(m) for m in (*MEASURES, SCORE_SUM)}))


def merged_mart(mart: DataFrame, deltas: DataFrame, name: str) -> DataFrame:
    """A mart with the deltas added; groups left without a transaction go."""
    rows = mart.unionByName(pick_mart(deltas, name))
    extra = [F.sum(SCORE_SUM).alias(SCORE_SUM)] if name == "gold_segmento_score" else []
    return rows.groupBy(*MARTS[name]).agg(*additive(rows), *extra).where("transacoes > 0")


def conservation(marts: dict[str, DataFrame], silver: DataFrame) -> DataFrame:
    """Per mart: rows, summed transactions, and whether they equal Silver's rows."""
    rows = None
    for name, df in marts.items():
        one = df.agg(
            F.lit(name).alias("mart"),
            F.count("*").alias("linhas"),
            F.sum("transacoes").alias("transacoes"),
        )
        rows = one if rows is None else rows.unionByName(one)
    total = silver.agg(F.count("*").alias("n")).scalar()
    return rows.select("*", (F.col("transacoes") == total).alias("confere"))


def totals(cube: DataFrame, measure: str) -> Column:
    """A grand total as a scalar subquery, planned once and reused."""
    return cube.agg(F.sum(measure).alias("t")).scalar()


def rates(n: Column, f: Column) -> Column:
    return percent(f, n, 2).alias("taxa_fraude_pct")


def kpi(source: DataFrame, dims: Sequence, cube: DataFrame) -> DataFrame:
    """Volume, fraud, shares, rate and lift per group of a mart.

    Shares are relative to all groups of ``source``; lift is relative to the
    overall rate of the risk cube. The unpartitioned window runs over the
    grouped rows only, whose number the dimension domains bound.
    """
    grouped = source.groupBy(*dims).agg(
        F.sum("transacoes").alias("transacoes"),
        F.sum("fraudes").alias("fraudes"),
        from_cents(F.sum(cents(F.col("valor_fraude")))).alias("valor_fraude"),
    )
    every = Window.partitionBy()
    n, f = F.col("transacoes"), F.col("fraudes")
    overall = ratio(totals(cube, "fraudes"), totals(cube, "transacoes"))
    keys = [c for c in grouped.columns if c not in ("transacoes", "fraudes", "valor_fraude")]
    return grouped.select(
        *keys,
        n,
        percent(n, F.sum(n).over(every), 1).alias("pct_volume"),
        f,
        percent(f, F.sum(f).over(every), 1).alias("pct_fraudes"),
        rates(n, f),
        round_half(F.try_divide(ratio(f, n), overall), 2).alias("lift"),
        "valor_fraude",
    )
