"""Running totals, areas, captures and independence against brute force."""

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from risklake.operators.ranking import (
    auc,
    capture_top,
    chi2,
    chi2_tail,
    running_total,
    separation,
)


def test_running_total_over_many_partitions(spark):
    values = {"a": list(range(700)), "b": [5, 1, 9]}
    data = [(s, float(x), x % 4) for s, xs in values.items() for x in xs]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "s string, o double, v int")
    got = {(r.s, r.o): r.cum_v for r in running_total(df, ["s"], "o", ["v"]).collect()}
    assert len(got) == len(data)
    for s, xs in values.items():
        total = 0
        for x in sorted(xs):
            total += x % 4
            assert got[(s, float(x))] == total


def scored(spark, n=3000, seed=7):
    rng = random.Random(seed)
    data = [
        (i, float(rng.choice([1, 2, 3, 50, 60])), rng.random(), rng.random() < 0.2)
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, "id long, s double, u double, y boolean")


def test_areas_equal_the_exact_evaluator(spark):
    _, df = scored(spark)
    got = {r.variavel: r for r in separation(df, ["s", "u"], "y").collect()}
    labelled = df.withColumn("label", F.col("y").cast("double"))
    for column in ("s", "u"):
        for metric, field in (("areaUnderROC", "auc"), ("areaUnderPR", "auc_pr")):
            exact = BinaryClassificationEvaluator(
                labelCol="label", rawPredictionCol=column, metricName=metric, numBins=0
            ).evaluate(labelled)
            assert got[column][field] == pytest.approx(exact, abs=2e-6)


def test_auc_without_a_class_is_null(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True)], "s double, y boolean")
    assert auc(df, ["s"], "y").first().auc is None


@pytest.mark.parametrize("column", ["s", "u"])
def test_capture_top_matches_a_full_sort(spark, column):
    data, df = scored(spark)
    at = {"s": 1, "u": 2}[column]
    ranked = sorted(data, key=lambda r: (-r[at], r[0]))
    frauds = sum(r[3] for r in data)
    for r in capture_top(df, column, "id", "y", (0.05, 0.1, 0.2, 0.0335)).collect():
        k = round(len(data) * r.fatia)
        hits = sum(x[3] for x in ranked[:k])
        assert (r.transacoes_revisadas, r.fraudes) == (k, hits)
        assert r.recall_pct == pytest.approx(100 * hits / frauds, abs=1e-4)
        assert r.precisao_pct == pytest.approx(100 * hits / k, abs=1e-4)


def test_published_independence_table(spark):
    # --- fixed values: published counts per credit band ---
    counts = [("1_baixo", 93, 4718 - 93), ("2_medio", 377, 15252 - 377), ("3_alto", 281, 10030 - 281)]
    df = spark.createDataFrame(counts, "banda string, f long, l long")
    r = chi2(df, "banda", ["f", "l"]).first()
    assert r.graus == 2
    assert r.p_valor == pytest.approx(0.010, abs=5e-4)


def test_chi_square_tail(spark):
    cases = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05)]
    df = spark.createDataFrame(cases, "x double, k int, p double")
    for r in df.select("p", chi2_tail(F.col("x"), F.col("k")).alias("q")).collect():
        assert r.q == pytest.approx(r.p, abs=1e-6)
    one = spark.createDataFrame([(2.0, 1)], "x double, k int")
    assert one.select(chi2_tail(F.col("x"), F.col("k"))).first()[0] == pytest.approx(
        math.erfc(1.0), abs=1e-9
    )


def test_chi_square_tail_at_any_size(spark):
    """Against closed forms; far out the result is tiny or 0, never NaN."""
    tail = {
        1: lambda x: math.erfc(math.sqrt(x / 2)),
        2: lambda x: math.exp(-x / 2),
        3: lambda x: math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2),
    }
    cases = [(float(x), k) for x in (0, 1e-9, 0.5, 6.2, 6.3, 50, 1400, 1600, 1e6) for k in (1, 2, 3)]
    df = spark.createDataFrame(cases, "x double, k int")
    for r in df.select("x", "k", chi2_tail(F.col("x"), F.col("k")).alias("p")).collect():
        assert r.p == pytest.approx(tail[r.k](r.x), rel=1e-9, abs=1e-300)


def test_capture_counts_rows_without_score_and_tiny_fractions(spark):
    rows = [(i, float(i) if i < 10 else None, i % 2 == 1) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, s double, y boolean")
    got = {r.fatia: r for r in capture_top(df, "s", "id", "y", (0.01, 0.5, 0.75)).collect()}
    assert {f: (r.transacoes_revisadas, r.fraudes) for f, r in got.items()} == {
        0.01: (0, 0), 0.5: (10, 5), 0.75: (15, 7),
    }
    assert got[0.01].precisao_pct is None


def test_capture_of_each_group_is_that_of_the_group_alone(spark):
    rows = [(i, f"g{i % 3}", None if i % 11 == 0 else float(i * 7 % 13), i % 5 == 0) for i in range(200)] + [(999, "one", 1.0, True)]
    df = spark.createDataFrame(rows, "id long, g string, s double, y boolean")
    got = {}
    for r in capture_top(df, "s", "id", "y", by=["g"]).collect():
        got.setdefault(r.g, []).append(tuple(r)[1:])
    for g in ("g0", "g1", "g2", "one"):
        alone = capture_top(df.where(f"g = '{g}'"), "s", "id", "y").collect()
        assert sorted(got[g], key=str) == sorted(map(tuple, alone), key=str)
