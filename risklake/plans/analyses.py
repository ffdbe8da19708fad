"""The published fraud analyses, each a query over Gold or one pass over Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import SIMULATED_RULES
from risklake.functions.numeric import cents, from_cents, percent, ratio, round_half
from risklake.operators.metrics import additive, kpi, rates
from risklake.operators.ranking import auc, capture_top, chi2
from risklake.plans.lakehouse import Lake

BY_RATE = F.desc_nulls_last


def overview(cube: DataFrame) -> DataFrame:
    """Twelve headline KPIs in one row."""
    c = F.col
    t = cube.agg(*additive(cube))
    vt, vf = cents(c("valor_total")).cast("double"), cents(c("valor_fraude")).cast("double")
    hundred = F.lit(100.0)
    return t.select(
        "transacoes",
        "fraudes",
        rates(c("transacoes"), c("fraudes")),
        "valor_total",
        "valor_fraude",
        round_half(F.try_divide(hundred * vf, vt), 2).alias("pct_valor_fraudado"),
        round_half(ratio(c("valor_fraude"), c("fraudes")), 2).alias("ticket_medio_fraude"),
        round_half(ratio(c("valor_total"), c("transacoes")), 2).alias("ticket_medio_geral"),
        "recusadas",
        "recusas_legitimas",
        percent(c("recusas_legitimas"), c("recusadas"), 1).alias("pct_recusas_que_eram_legitimas"),
        percent(c("recusas_legitimas"), c("transacoes") - c("fraudes"), 2).alias(
            "pct_legitimas_recusadas"
        ),
    )


def _ranked(df: DataFrame, *ties: str) -> DataFrame:
    return df.orderBy(BY_RATE("taxa_fraude_pct"), *ties)


def by_segment(lake: Lake) -> DataFrame:
    return _ranked(kpi(lake.cube, ["segment"], lake.cube), "segment")


def by_credit_band(lake: Lake) -> DataFrame:
    scores = lake.mart("gold_segmento_score")
    return kpi(scores, ["faixa_credit_score"], lake.cube).orderBy("faixa_credit_score")


def mean_credit_by_segment(lake: Lake) -> DataFrame:
    mean = ratio(F.sum("soma_credit_score"), F.sum("transacoes"))
    return (
        lake.mart("gold_segmento_score")
        .groupBy("segment")
        .agg(round_half(mean, 0).alias("credit_score_medio"))
        .orderBy("segment")
    )


def by_segment_channel(lake: Lake) -> DataFrame:
    return _ranked(kpi(lake.cube, ["segment", "channel"], lake.cube), "segment", "channel")


def by_channel(lake: Lake) -> DataFrame:
    return _ranked(kpi(lake.cube, ["channel"], lake.cube), "channel")


def by_category(lake: Lake) -> DataFrame:
    return _ranked(kpi(lake.cube, ["merchant_category"], lake.cube), "merchant_category")


def top_channel_category(lake: Lake, k: int = 10) -> DataFrame:
    """The k riskiest pairs; shares still relate to all pairs."""
    dims = ["channel", "merchant_category"]
    return _ranked(kpi(lake.cube, dims, lake.cube), *dims).limit(k)


def by_period(lake: Lake) -> DataFrame:
    return _ranked(kpi(lake.cube, ["periodo_dia"], lake.cube), "periodo_dia")


def _plain(df: DataFrame, *dims: str, value: bool = False) -> DataFrame:
    g = df.groupBy(*dims).agg(*additive(df))
    kept = ["valor_fraude"] if value else []
    return g.select(
        *dims, "transacoes", "fraudes", rates(F.col("transacoes"), F.col("fraudes")), *kept
    ).orderBy(*dims)


def by_hour(lake: Lake) -> DataFrame:
    return _plain(lake.mart("gold_perfil_horario"), "hora")


def by_weekday(lake: Lake) -> DataFrame:
    return _plain(lake.mart("gold_perfil_horario"), "dia_semana_num", "dia_semana")


def by_month(lake: Lake) -> DataFrame:
    return _plain(lake.cube, "month", value=True)


def app_travel_by_night(lake: Lake) -> DataFrame:
    app_travel = (F.col("channel") == "app") & (F.col("merchant_category") == "viagem")
    night = F.col("periodo_dia") == "madrugada"
    dims = [app_travel.alias("app_viagem"), night.alias("madrugada")]
    return kpi(lake.cube, dims, lake.cube).orderBy("app_viagem", "madrugada")


def by_risk_band(lake: Lake) -> DataFrame:
    scores = lake.mart("gold_segmento_score")
    return kpi(scores, ["faixa_risk_score"], lake.cube).orderBy("faixa_risk_score")


def lone_auc(lake: Lake) -> DataFrame:
    return auc(lake.silver, ["risk_score", "credit_score", "amount"], "is_fraud")


def auc_by_month(lake: Lake) -> DataFrame:
    """The current engine's separation, month by month."""
    return auc(lake.silver, ["risk_score"], "is_fraud", by=["year", "month"])


def capture_by_month(lake: Lake) -> DataFrame:
    """Frauds that the current engine's top fractions catch, month by month."""
    return capture_top(lake.silver, "risk_score", "transaction_id", "is_fraud", by=["year", "month"])


def credit_independence(lake: Lake) -> DataFrame:
    scores = lake.mart("gold_segmento_score")
    counts = scores.select(
        "faixa_credit_score",
        F.col("fraudes"),
        (F.col("transacoes") - F.col("fraudes")).alias("legitimas"),
    )
    return chi2(counts, "faixa_credit_score", ["fraudes", "legitimas"])


def channel_independence(lake: Lake) -> DataFrame:
    """Fraud against the four channels: three degrees of freedom."""
    counts = lake.cube.select("channel", "fraudes", (F.col("transacoes") - F.col("fraudes")).alias("legitimas"))
    return chi2(counts, "channel", ["fraudes", "legitimas"])


def candidate_rules() -> dict[str, Column]:
    """Overlapping alert rules by label."""
    engine = F.col("risk_score") >= 80
    app = F.col("channel") == "app"
    travel = F.col("merchant_category") == "viagem"
    high = F.col("segment") == "High-Risk"
    night = F.col("periodo_dia") == "madrugada"
    conditions = {
        "R1": engine,
        "R2": app & travel,
        "R3": high & app,
        "R4": high,
        "R5": high | (app & travel),
        "R6": high | (app & (travel | night)),
    }
    return {SIMULATED_RULES[k]: cond for k, cond in conditions.items()}


def simulate_rules(silver: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Alerts, captures and precision of every rule from a single scan."""
    fraud = F.col("is_fraud")
    tallies = silver.agg(
        F.count("*").alias("_n"),
        F.count_if(fraud).alias("_f"),
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("regra"),
                    F.count_if(cond).alias("alertas"),
                    F.count_if(cond & fraud).alias("fraudes_capturadas"),
                )
                for name, cond in rules.items()
            ]
        ).alias("_r"),
    )
    c = F.col
    return (
        tallies.select("_n", "_f", F.inline("_r"))
        .select(
            "regra",
            "alertas",
            percent(c("alertas"), c("_n"), 1).alias("pct_volume_alertado"),
            "fraudes_capturadas",
            percent(c("fraudes_capturadas"), c("_f"), 1).alias("pct_fraudes_capturadas"),
            percent(c("fraudes_capturadas"), c("alertas"), 2).alias("precisao_pct"),
            (c("alertas") - c("fraudes_capturadas")).alias("legitimas_incomodadas"),
        )
        .orderBy("regra")
    )


def rule_simulation(lake: Lake) -> DataFrame:
    return simulate_rules(lake.silver, candidate_rules())


def segment_check(lake: Lake) -> DataFrame:
    """Rate by segment straight from the cube, as a build sanity check."""
    cube = lake.cube
    return cube.groupBy("segment").agg(*additive(cube)).select(
        "segment",
        "transacoes",
        "fraudes",
        rates(F.col("transacoes"), F.col("fraudes")),
        "valor_fraude",
    ).orderBy(BY_RATE("taxa_fraude_pct"), "segment")


def fraud_by_type(lake: Lake) -> DataFrame:
    g = lake.silver.groupBy("transaction_type").agg(
        F.count("*").alias("transacoes"),
        F.count_if("is_fraud").alias("fraudes"),
        from_cents(F.sum(F.when(F.col("is_fraud"), cents(F.col("amount"))).otherwise(0))).alias(
            "valor_fraude"
        ),
    )
    return g.select("*", rates(F.col("transacoes"), F.col("fraudes"))).orderBy("transaction_type")
