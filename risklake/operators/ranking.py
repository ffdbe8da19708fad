"""Distributed running totals and the statistics built on them.

A running total over a whole table would sort everything in one task. Here the
order is cut into range partitions: each is accumulated on its own and shifted by
the totals of the partitions before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risklake.functions.numeric import percent, round_half
from risklake.session import written


def running_total(
    df: DataFrame, series: Sequence[str], order: str, values: Sequence[str]
) -> DataFrame:
    """Add ``cum_<value>``: inclusive sums in ascending ``order`` per series.

    ``order`` must be unique within a series (aggregate ties first), and series
    few (a variable, a month, a cut), never a row-level key. The rows are written
    once in order, each with the number of the partition that holds it; there are
    as many partitions as the data needs. Each is accumulated on its own and
    shifted by the totals of the partitions before it.
    """
    ranged = df.repartitionByRange(*series, order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ordem")
    keys = [*series, "_part"]
    before = Window.partitionBy(*series).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy(*keys)
        .agg(*[F.sum(v).alias(f"_in_{v}") for v in values])
        .select(
            *keys,
            *[
                F.coalesce(F.sum(f"_in_{v}").over(before), F.lit(0)).alias(f"_before_{v}")
                for v in values
            ],
        )
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.select("*", *[F.sum(v).over(inside).alias(f"_cum_{v}") for v in values])
        .join(offsets, keys)
        .select(
            *df.columns,
            *[(F.col(f"_before_{v}") + F.col(f"_cum_{v}")).alias(f"cum_{v}") for v in values],
        )
    )


def score_histogram(
    df: DataFrame, scores: Sequence[str], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score value, all scores in one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("variavel"), F.col(s).cast("double").alias("escore"))
            for s in scores
        ]
    )
    return (
        df.select(*by, F.col(label).alias("_y"), F.inline(pairs))
        .groupBy(*by, "variavel", "escore")
        .agg(F.count_if("_y").alias("pos"), F.count_if(~F.col("_y")).alias("neg"))
    )


def separation(
    df: DataFrame, scores: Sequence[str], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Exact areas under the ROC and precision-recall curves per score.

    Rows collapse to one per distinct score value before anything is ordered;
    running counts from the highest score down then give both areas. Ties count
    half in the ROC area; precision is interpolated linearly between distinct
    scores. NULL where a class is absent.
    """
    series = [*by, "variavel"]
    hist = score_histogram(df, scores, label, by).where(F.col("escore").isNotNull())
    ranked = running_total(
        hist.select("*", (-F.col("escore")).alias("_desc")), series, "_desc", ["pos", "neg"]
    )
    p, n = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    precision = tp / (tp + fp)
    earlier = F.coalesce(F.try_divide(tp - p, tp + fp - p - n), precision)
    sums = ranked.groupBy(*series).agg(
        F.sum(p * (F.lit(2.0) * fp - n)).alias("_losses2"),
        F.sum(p * (precision + earlier) / F.lit(2.0)).alias("_pr"),
        F.sum("pos").alias("positivos"),
        F.sum("neg").alias("negativos"),
    )
    pos, neg = F.col("positivos").cast("double"), F.col("negativos").cast("double")
    pairs2 = F.lit(2.0) * pos * neg
    return sums.select(
        *series,
        "positivos",
        "negativos",
        round_half(F.try_divide(pairs2 - F.col("_losses2"), pairs2), 6).alias("auc"),
        round_half(F.try_divide(F.col("_pr"), pos), 6).alias("auc_pr"),
    )


def auc(df: DataFrame, scores: Sequence[str], label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve per score, ties counted half."""
    return separation(df, scores, label, by).drop("auc_pr")


def capture_top(
    df: DataFrame,
    score: str,
    id_: str,
    label: str,
    fractions: Sequence[float] = (0.05, 0.10, 0.20),
    by: Sequence[str] = (),
) -> DataFrame:
    """Frauds caught when reviewing the top fractions by score, of all rows or of each group.

    Reviewed rows are the k = n x fraction highest scores (half-even rounding),
    ties broken by ascending id; n counts all rows, and those without a score come
    last. A fraction too small for one row is reported with none. Scores above the
    cut are settled on the score histogram; only the rows tied at a cut score are
    ordered by id. Groups are few (months, say); each has one cut per fraction, found on
    its histogram, and a group of any size is spread over many partitions.
    """
    by = list(by)
    lowest = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    df = df.withColumn(score, lowest).withColumn("_s", F.lit(1))
    group = ["_s", *by]
    hist = written(
        df.groupBy(*group, score)
        .agg(F.count("*").alias("n"), F.count_if(F.col(label)).alias("f")),
        "histograma",
    )
    ranked = running_total(
        hist.select(*group, score, (-F.col(score)).alias("_desc"), "n", "f"), group, "_desc", ["n", "f"]
    )
    totals = hist.groupBy(*group).agg(F.sum("n").alias("_rows"), F.sum("f").alias("_frauds"))
    if not by:
        none = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_rows", "_frauds")]
        totals = totals.agg(*none).select(F.lit(1).alias("_s"), "*")
    k = F.bround(F.col("_rows") * F.col("fatia"), 0).cast("bigint")
    slices = F.explode(F.array(*[F.lit(float(x)) for x in fractions])).alias("fatia")
    every = totals.select("*", slices).withColumn("k", k)
    cuts = (
        _joined(ranked, every, group)
        .where((F.col("cum_n") - F.col("n") < F.col("k")) & (F.col("k") <= F.col("cum_n")))
        .select(
            *group,
            "fatia",
            F.col(score),
            (F.col("k") - F.col("cum_n") + F.col("n")).alias("_take"),
            (F.col("cum_f") - F.col("f")).alias("_above"),
        )
    )
    tied = _joined(df, cuts, [*group, score]).select(
        *group,
        "fatia",
        "_take",
        "_above",
        F.col(id_).alias("_id"),
        F.lit(1).alias("_one"),
        F.col(label).cast("int").alias("_y"),
    )
    taken = running_total(tied, [*group, "fatia"], "_id", ["_one"]).where("cum__one <= _take")
    caught = F.first("_above") + F.sum("_y")
    found = taken.groupBy(*group, "fatia").agg(caught.alias("fraudes"))
    fraudes = F.coalesce("fraudes", F.lit(0))
    return _joined(every, found, [*group, "fatia"], "left").select(
        *by,
        "fatia",
        F.col("k").alias("transacoes_revisadas"),
        fraudes.cast("bigint").alias("fraudes"),
        percent(fraudes, F.col("_frauds"), 4).alias("recall_pct"),
        percent(fraudes, F.col("k"), 4).alias("precisao_pct"),
    )


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join where NULL keys meet one another."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys])
    return left.join(other, same, how).drop(*[f"_r_{c}" for c in keys])


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(chi-square with ``dof`` degrees of freedom > x), as a column expression.

    Both parities have finite sums: of a Poisson tail for even degrees of freedom,
    of its half-integer counterpart beside the normal tail for odd ones. Every term
    is positive and is evaluated as one exponential, so large statistics neither
    cancel nor overflow.
    """
    half = x / F.lit(2.0)
    odd = dof % 2 == 1
    terms = F.when(odd, ((dof - 1) / 2).cast("int")).otherwise((dof / 2).cast("int"))
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    # Logarithms of gamma(i + shift + 1), built up from gamma(1) and gamma(3/2).
    start = F.struct(
        F.when(odd, F.log(F.sqrt(F.pi()) / 2)).otherwise(F.lit(0.0)).alias("g"), F.lit(0.0).alias("s")
    )

    def add(a: Column, i: Column) -> Column:
        power = i.cast("double") + shift
        at_zero = F.when(power > 0, F.lit(0.0)).otherwise(F.lit(1.0))
        term = F.when(half > 0, F.exp(power * F.log(half) - half - a["g"])).otherwise(at_zero)
        return F.struct((a["g"] + F.log(power + 1)).alias("g"), (a["s"] + term).alias("s"))

    counted = F.when(terms > 0, F.sequence(F.lit(0), terms - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(counted, start, add, lambda a: a["s"])
    return total + F.when(odd, normal_tail2(F.sqrt(x))).otherwise(F.lit(0.0))


def normal_tail2(z: Column, levels: int = 120) -> Column:
    """P(|normal| > z) for z >= 0.

    Below 2.5 by the series of positive terms for the centre, beyond by the
    continued fraction of the tail, evaluated from its end; both are converged to
    double precision there at this depth.
    """
    down = F.sequence(F.lit(levels), F.lit(1), F.lit(-1))
    fraction = F.aggregate(down, z, lambda f, i: z + i.cast("double") / f)
    density = F.exp(-z * z / 2) * math.sqrt(2 / math.pi)
    up = F.sequence(F.lit(1), F.lit(levels))
    centre = F.aggregate(
        up,
        F.struct(z.alias("t"), z.alias("s")),
        lambda a, i: F.struct(
            (a["t"] * z * z / (2 * i + 1)).alias("t"), (a["s"] + a["t"] * z * z / (2 * i + 1)).alias("s")
        ),
        lambda a: a["s"],
    )
    return F.when(z < 2.5, F.lit(1.0) - density * centre).otherwise(density / fraction)


def chi2(counts: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """Pearson independence test on a contingency table.

    ``counts`` has one line per level of ``row`` and one count column per level
    of the other attribute. No continuity correction.
    """
    table = counts.groupBy(row).agg(*[F.sum(c).cast("double").alias(c) for c in columns])
    grand = table.agg(*[F.sum(c).alias(f"_t_{c}") for c in columns], F.count("*").alias("_rows"))
    line = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    whole = sum((F.col(f"_t_{c}") for c in columns[1:]), F.col(f"_t_{columns[0]}"))
    totals = grand.agg(F.first(F.struct("*")).alias("g")).scalar()
    cells = table.withColumn("_g", totals).select(
        *columns, *[F.col(f"_g._t_{c}").alias(f"_t_{c}") for c in columns], "_g._rows"
    )
    parts = [
        F.pow(F.col(c) - line * F.col(f"_t_{c}") / whole, F.lit(2.0))
        / (line * F.col(f"_t_{c}") / whole)
        for c in columns
    ]
    stat = cells.agg(
        F.sum(sum(parts[1:], parts[0])).alias("_x"),
        ((F.first("_rows") - 1) * (len(columns) - 1)).cast("int").alias("graus"),
    )
    return stat.select(
        round_half(F.col("_x"), 6).alias("chi2"),
        "graus",
        round_half(chi2_tail(F.col("_x"), F.col("graus")), 6).alias("p_valor"),
    )
