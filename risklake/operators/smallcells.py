"""Merging small cells into broader groups, and the capture curve over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risklake.functions.numeric import cents, from_cents, percent, ratio, round_half

# Finest to broadest; each level drops one dimension of the one before.
LEVELS = (
    ("channel", "merchant_category", "segment", "periodo_dia"),
    ("channel", "merchant_category", "segment"),
    ("channel", "segment"),
    ("segment",),
)
CELL = LEVELS[0]


def merge_small_cells(cube: DataFrame, min_n: int) -> DataFrame:
    """Emit each cell at the first level where its group reaches ``min_n``.

    At every level only cells still pending are counted, so a broader group
    excludes what a finer one already emitted. What never qualifies ends in one
    remainder row (``nivel`` 0). The cube is summed over months first: what the
    windows see is bounded by the product of the dimension domains.
    """
    cells = cube.groupBy(*CELL).agg(
        F.sum("transacoes").alias("transacoes"),
        F.sum("fraudes").alias("fraudes"),
        F.sum(cents(F.col("valor_fraude"))).alias("_vf"),
    )
    cells = cells.withColumn("nivel", F.lit(0))
    for keys in LEVELS:
        pending = F.when(F.col("nivel") == 0, F.col("transacoes"))
        size = F.sum(pending).over(Window.partitionBy(*keys))
        cells = cells.withColumn(
            "nivel",
            F.when((F.col("nivel") == 0) & (size >= min_n), F.lit(len(keys))).otherwise(
                F.col("nivel")
            ),
        )
    shown = [
        F.when(F.col("nivel").isin(*[len(k) for k in LEVELS if d in k]), F.col(d)).alias(d)
        for d in CELL
    ]
    return (
        cells.select("nivel", *shown, "transacoes", "fraudes", "_vf")
        .groupBy("nivel", *CELL)
        .agg(
            F.sum("transacoes").alias("transacoes"),
            F.sum("fraudes").alias("fraudes"),
            from_cents(F.sum("_vf")).alias("valor_fraude"),
        )
    )


def _risk_order() -> list[Column]:
    """Remainder last, then rate and volume descending, then a fixed tie-break."""
    return [
        (F.col("nivel") == 0).asc(),
        ratio(F.col("fraudes"), F.col("transacoes")).desc(),
        F.col("transacoes").desc(),
        F.col("nivel").desc(),
        *[F.col(d).asc_nulls_first() for d in CELL],
    ]


def capture_curve(groups: DataFrame) -> DataFrame:
    """Cumulative volume and frauds along the groups in risk order.

    The unpartitioned window holds one row per merged group, a few hundred at
    most by construction.
    """
    line = Window.orderBy(*_risk_order())
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    n, f = F.col("transacoes"), F.col("fraudes")
    return groups.select(
        "*",
        F.row_number().over(line).alias("posicao"),
        F.sum(n).over(upto).alias("transacoes_acum"),
        F.sum(f).over(upto).alias("fraudes_acum"),
        F.sum(n).over(every).alias("transacoes_total"),
        F.sum(f).over(every).alias("fraudes_total"),
    )


def curve_points(curve: DataFrame) -> DataFrame:
    c = F.col
    return curve.select(
        "posicao",
        "nivel",
        *CELL,
        "transacoes",
        "fraudes",
        "transacoes_acum",
        "fraudes_acum",
        percent(c("transacoes_acum"), c("transacoes_total"), 4).alias("pct_volume_acum"),
        F.coalesce(
            percent(c("fraudes_acum"), c("fraudes_total"), 4), F.lit(0.0)
        ).alias("pct_fraudes_acum"),
    )


def selected(pct: float) -> Column:
    """Groups whose preceding cumulative volume is below the cut.

    The group that crosses the cut is included, so the selection may overshoot.
    """
    preceding = F.col("transacoes_acum") - F.col("transacoes")
    return F.try_divide(
        F.lit(100.0) * preceding.cast("double"), F.col("transacoes_total").cast("double")
    ) < F.lit(float(pct))


def cutoff(curve: DataFrame, pct: float) -> DataFrame:
    """What reviewing the groups above the cut would reach and disturb."""
    chosen = curve.where(selected(pct)).agg(
        F.count("*").alias("grupos"),
        F.coalesce(F.sum("transacoes"), F.lit(0)).alias("transacoes"),
        F.coalesce(F.sum("fraudes"), F.lit(0)).alias("fraudes"),
        F.max("transacoes_total").alias("_n"),
        F.max("fraudes_total").alias("_f"),
    )
    c = F.col
    return chosen.select(
        F.lit(float(pct)).alias("corte_pct"),
        "grupos",
        "transacoes",
        percent(c("transacoes"), c("_n"), 4).alias("pct_volume"),
        "fraudes",
        percent(c("fraudes"), c("_f"), 4).alias("pct_fraudes"),
        percent(c("fraudes"), c("transacoes"), 4).alias("taxa_pct"),
        (c("transacoes") - c("fraudes")).alias("legitimas_incomodadas"),
    )


def ranked_table(
    curve: DataFrame, overall_rate: Column, pct: float, sort: str = "taxa_pct", desc: bool = True
) -> DataFrame:
    """The review table: curve columns, rate against the overall rate, cut flag.

    ``sort`` orders by any output column; the remainder row stays last.
    """
    c = F.col
    rate = ratio(c("fraudes"), c("transacoes"))
    table = curve.select(
        "posicao",
        "nivel",
        *CELL,
        round_half(F.try_divide(rate, overall_rate), 4).alias("razao_geral"),
        "transacoes",
        "fraudes",
        percent(c("fraudes"), c("transacoes"), 4).alias("taxa_pct"),
        "valor_fraude",
        percent(c("transacoes_acum"), c("transacoes_total"), 4).alias("pct_volume_acum"),
        F.coalesce(
            percent(c("fraudes_acum"), c("fraudes_total"), 4), F.lit(0.0)
        ).alias("pct_fraudes_acum"),
        F.coalesce(selected(pct), F.lit(False)).alias("no_corte"),
    )
    column = c(sort).desc_nulls_last() if desc else c(sort).asc_nulls_last()
    return table.orderBy((c("nivel") == 0).asc(), column, "posicao")
