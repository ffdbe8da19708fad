"""Physical plans: pruning, pushdown, and shuffles that must not be there."""

import re

from pyspark.sql import functions as F

from risklake.operators import metrics
from risklake.operators.enrich import silver
from risklake.operators.quality import evaluate, quality_rules
from risklake.plans import analyses


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_filter_prunes_partitions(lake):
    march = lake.raw.where((F.col("year") == 1998) & (F.col("month") == 3))
    assert re.search(r"PartitionFilters: \[[^]]*year[^]]*month", plan(march))
    assert len(march.inputFiles()) >= 1
    files = march.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert {re.search(r"year=(\d+)/month=(\d+)", r.f).groups() for r in files} == {("1998", "3")}


def test_value_filter_reaches_the_scan(lake):
    picked = lake.silver.where(F.col("risk_score") >= 80).select("amount")
    text = plan(picked)
    assert "GreaterThanOrEqual(risk_score,80.0)" in text
    assert re.search(r"ReadSchema: struct<amount:double,risk_score:double>", text)


def test_mart_reads_only_its_columns(lake):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(metrics.mart(lake.silver, "gold_serie_diaria")))
    names = {c.split(":")[0] for c in schema.group(1).split(",")}
    assert names == {"amount", "channel", "is_fraud", "data", "recusada"}


def test_silver_and_rules_need_no_shuffle(lake):
    assert "Exchange" not in plan(silver(lake.bronze))
    evaluated = plan(evaluate(lake.staged(), quality_rules(lake.bounds)))
    assert evaluated.count("Exchange") == evaluated.count("BroadcastExchange")


def test_all_marts_scan_silver_once(lake):
    text = plan(metrics.all_marts(lake.silver))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_rule_simulation_is_one_scan(lake):
    assert plan(analyses.simulate_rules(lake.silver, analyses.candidate_rules())).count("FileScan") == 1


def test_no_python_in_the_hot_path(lake):
    for df in (
        evaluate(lake.staged(), quality_rules(lake.bounds)),
        metrics.all_marts(lake.silver),
        analyses.lone_auc(lake),
    ):
        assert "Python" not in plan(df)


def test_single_row_cross_joins_only(lake):
    for df in (analyses.by_segment(lake), analyses.rule_simulation(lake)):
        assert "CartesianProduct" not in plan(df)
