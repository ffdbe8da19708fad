"""Dashboard panels as queries over Gold.

``flt`` maps any of channel, merchant_category, segment, periodo_dia and month
to a value. Rates compare with the overall rate of the whole cube.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from risklake.config import CATEGORIES, CHANNELS
from risklake.functions.numeric import cents, from_cents, percent, ratio, round_half
from risklake.operators.crossfilter import apply_filters, condition
from risklake.operators.history import rolling_rate
from risklake.operators.metrics import MEASURES, additive, totals
from risklake.operators.smallcells import (
    capture_curve,
    curve_points,
    cutoff,
    merge_small_cells,
    ranked_table,
)

Filter = Mapping[str, object]
CUBE_DIMENSIONS = ("month", "channel", "merchant_category", "segment", "periodo_dia")


def overall_rate(cube: DataFrame) -> Column:
    return ratio(totals(cube, "fraudes"), totals(cube, "transacoes"))


def against_overall(rate: Column, overall: Column) -> Column:
    """'acima' / 'abaixo' outside a 5 % margin around the overall rate."""
    return (
        F.when(rate > overall * F.lit(1.05), F.lit("acima"))
        .when(rate < overall * F.lit(0.95), F.lit("abaixo"))
        .otherwise(F.lit("neutra"))
    )


def base_cube(cube: DataFrame) -> DataFrame:
    """The cube's cells and measures, the data set every filtered panel starts from."""
    return cube.select("year", *CUBE_DIMENSIONS, *MEASURES)


def kpis(cube: DataFrame, flt: Filter | None = None) -> DataFrame:
    """The four KPI cards of a slice, from one pass over the cube."""
    inside = condition(flt or {})
    zero = F.lit(0)

    def part(column: Column) -> Column:
        return F.coalesce(F.sum(F.when(inside, column)), zero)

    t = cube.agg(
        part(F.col("transacoes")).alias("transacoes"),
        part(F.col("fraudes")).alias("fraudes"),
        part(F.col("recusadas")).alias("recusadas"),
        part(F.col("recusas_legitimas")).alias("recusas_legitimas"),
        part(cents(F.col("valor_total"))).alias("_v"),
        part(cents(F.col("valor_fraude"))).alias("_vf"),
        F.sum("transacoes").alias("_n"),
        F.sum("fraudes").alias("_f"),
    )
    c = F.col
    rate = ratio(c("fraudes"), c("transacoes"))
    overall = ratio(c("_f"), c("_n"))
    fraud_value = from_cents(c("_vf"))
    return t.select(
        "transacoes",
        percent(c("transacoes"), c("_n"), 4).alias("pct_volume_total"),
        from_cents(c("_v")).alias("valor_total"),
        "fraudes",
        percent(c("fraudes"), c("transacoes"), 4).alias("taxa_pct"),
        percent(c("_f"), c("_n"), 4).alias("taxa_geral_pct"),
        round_half(F.try_divide(rate, overall), 4).alias("razao_geral"),
        against_overall(F.coalesce(rate, F.lit(0.0)), overall).alias("classe"),
        fraud_value.alias("valor_fraude"),
        percent(c("_vf"), c("_v"), 4).alias("pct_valor"),
        round_half(ratio(fraud_value, c("fraudes")), 4).alias("ticket_fraude"),
        "recusadas",
        "recusas_legitimas",
        percent(c("recusas_legitimas"), c("recusadas"), 4).alias("pct_recusas"),
        percent(c("recusas_legitimas"), c("transacoes") - c("fraudes"), 4).alias("pct_legitimas"),
    )


def monthly(cube: DataFrame, flt: Filter | None = None) -> DataFrame:
    """Volume and rate per month beside the overall rate; ignores a month filter."""
    g = apply_filters(cube, flt or {}, ignore=["month"]).groupBy("month").agg(
        F.sum("transacoes").alias("transacoes"), F.sum("fraudes").alias("fraudes")
    )
    return g.select(
        "*",
        percent(F.col("fraudes"), F.col("transacoes"), 4).alias("taxa_pct"),
        round_half(F.lit(100.0) * overall_rate(cube), 4).alias("taxa_geral_pct"),
    ).orderBy("month")


def daily(series: DataFrame, flt: Filter | None = None) -> DataFrame:
    """Seven-day rolling rate; only a channel filter applies."""
    only = {k: v for k, v in (flt or {}).items() if k == "channel"}
    labelled = rolling_rate(apply_filters(series, only)).select(
        "*", F.date_format("data", "yyyy-MM-dd").alias("dia")
    )
    return labelled.orderBy("data")


def daily_by_channel(series: DataFrame) -> DataFrame:
    return rolling_rate(series, ["channel"]).orderBy("channel", "data")


def bars(cube: DataFrame, dim: str, flt: Filter | None = None) -> DataFrame:
    """One bar per level of a dimension, ignoring the filter on that dimension."""
    kept = apply_filters(cube, flt or {}, ignore=[dim])
    g = kept.groupBy(dim).agg(*additive(kept))
    every = Window.partitionBy()
    n, f = F.col("transacoes"), F.col("fraudes")
    return g.select(
        dim,
        n,
        f,
        percent(f, n, 4).alias("taxa_pct"),
        against_overall(ratio(f, n), overall_rate(cube)).alias("classe"),
        percent(n, F.sum(n).over(every), 4).alias("pct_volume"),
        percent(f, F.sum(f).over(every), 4).alias("pct_fraudes"),
        "valor_fraude",
    ).orderBy("taxa_pct", dim)


def _grid(spark: SparkSession, **axes) -> DataFrame:
    """All combinations of fixed axis values, exploded from literals."""
    grid = spark.range(1)
    for name, values in axes.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return grid.drop("id")


def heat_channel_category(cube: DataFrame, flt: Filter | None = None) -> DataFrame:
    """Full channel x category grid; an empty cell has zero counts and no rate."""
    kept = apply_filters(cube, flt or {}, ignore=["channel", "merchant_category"])
    cells = kept.groupBy("channel", "merchant_category").agg(
        F.sum("transacoes").alias("transacoes"), F.sum("fraudes").alias("fraudes")
    )
    grid = _grid(cube.sparkSession, channel=CHANNELS, merchant_category=CATEGORIES)
    return grid.join(cells, ["channel", "merchant_category"], "left").select(
        "channel",
        "merchant_category",
        F.coalesce("transacoes", F.lit(0)).alias("transacoes"),
        F.coalesce("fraudes", F.lit(0)).alias("fraudes"),
        percent(F.col("fraudes"), F.col("transacoes"), 4).alias("taxa_pct"),
    )


def heat_hour_weekday(profile: DataFrame, cube: DataFrame) -> DataFrame:
    """Full weekday x hour grid with each hour's all-days rate; never filtered."""
    grid = _grid(profile.sparkSession, dia_semana_num=range(1, 8), hora=range(24))
    cells = profile.select("dia_semana_num", "hora", "transacoes", "fraudes")
    hour = Window.partitionBy("hora")
    whole_day = ratio(F.sum("fraudes").over(hour), F.sum("transacoes").over(hour))
    return grid.join(cells, ["dia_semana_num", "hora"], "left").select(
        "dia_semana_num",
        "hora",
        F.coalesce("transacoes", F.lit(0)).alias("transacoes"),
        F.coalesce("fraudes", F.lit(0)).alias("fraudes"),
        percent(F.col("fraudes"), F.col("transacoes"), 4).alias("taxa_pct"),
        round_half(F.lit(100.0) * whole_day, 4).alias("taxa_hora_pct"),
        against_overall(whole_day, overall_rate(cube)).alias("classe_hora"),
    )


def small_cells(cube: DataFrame, flt: Filter | None = None, min_n: int = 50) -> DataFrame:
    groups = merge_small_cells(apply_filters(cube, flt or {}), min_n)
    return groups.select(
        "*", percent(F.col("fraudes"), F.col("transacoes"), 4).alias("taxa_pct")
    )


def curve(cube: DataFrame, flt: Filter | None = None, min_n: int = 50) -> DataFrame:
    groups = merge_small_cells(apply_filters(cube, flt or {}), min_n)
    return curve_points(capture_curve(groups)).orderBy("posicao")


def cut(
    cube: DataFrame, flt: Filter | None = None, min_n: int = 50, pct: float = 20
) -> DataFrame:
    groups = merge_small_cells(apply_filters(cube, flt or {}), min_n)
    return cutoff(capture_curve(groups), pct)


def review_table(
    cube: DataFrame,
    flt: Filter | None = None,
    min_n: int = 50,
    pct: float = 20,
    sort: str = "taxa_pct",
    desc: bool = True,
) -> DataFrame:
    groups = merge_small_cells(apply_filters(cube, flt or {}), min_n)
    return ranked_table(capture_curve(groups), overall_rate(cube), pct, sort, desc)


def engine_point(scores: DataFrame, cube: DataFrame) -> DataFrame:
    """Where the current engine's top risk band sits on the capture chart."""
    top = scores.where(F.col("faixa_risk_score").like("3_%")).agg(
        F.coalesce(F.sum("transacoes"), F.lit(0)).alias("transacoes"),
        F.coalesce(F.sum("fraudes"), F.lit(0)).alias("fraudes"),
    )
    return top.select(
        "transacoes",
        "fraudes",
        percent(F.col("transacoes"), totals(cube, "transacoes"), 4).alias("pct_volume"),
        percent(F.col("fraudes"), totals(cube, "fraudes"), 4).alias("pct_fraudes"),
    )


def every_slice(cube: DataFrame) -> DataFrame:
    """All selector combinations at once, including 'all' on any selector.

    A NULL dimension means the selector is open; ``nivel`` tells which are.
    Grouping sets expand the cube mart, not the transactions.
    """
    return cube.cube(*CUBE_DIMENSIONS).agg(
        *additive(cube), F.grouping_id().cast("bigint").alias("nivel")
    )
