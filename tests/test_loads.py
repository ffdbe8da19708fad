"""Loads and maintenance: only what should change on disk changes."""

import glob
import os
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from risklake.operators.enrich import enrich_customer, orphans
from risklake.operators.history import customer_history, rolling_rate, weeks_above
from risklake.operators.labels import apply_late_labels
from risklake.operators.metrics import mart
from risklake.plans import loads
from risklake.plans.faults import rule_matrix
from risklake.sources import layers
from risklake.sources.incremental import incremental
from risklake.sources.layers import MONTHLY, read_layer, reprocess, write_layer
from risklake.streaming import jobs


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/year=*/month=*/part-*")}


def test_reprocess_touches_only_its_months(lake, tmp_path):
    path = str(tmp_path / "silver")
    write_layer(lake.silver, path, MONTHLY, spread=False)
    before = files(path)
    month = (F.col("year") == 2000) & (F.col("month") == 2)
    reprocess(lake.silver.where(month), path)
    after = files(path)
    changed = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert [c.split("silver/")[1] for c in changed] == ["year=2000/month=2"]
    assert read_layer(lake.spark, path).count() == lake.silver.count()


def test_late_labels_return_affected_months_only(lake):
    labels = loads.chargebacks(lake, 2001)
    updated = apply_late_labels(lake.silver, labels)
    labelled = lake.silver.join(labels, "transaction_id", "left_semi")
    touched = labelled.select("year", "month").distinct().count()
    assert updated.select("year", "month").distinct().count() == touched
    assert {r.year for r in updated.select("year").distinct().collect()} == {2001}
    assert updated.columns == lake.silver.columns


def test_latest_label_wins(spark, lake):
    row = lake.silver.where("not is_fraud").first()
    labels = spark.createDataFrame(
        [(row.transaction_id, True, 1), (row.transaction_id, False, 3), (row.transaction_id, True, 2)],
        "transaction_id long, is_fraud boolean, rotulado_em long",
    )
    updated = apply_late_labels(lake.silver, labels)
    assert updated.where(F.col("transaction_id") == row.transaction_id).first().is_fraud is False


def test_incremental_pushes_the_mark_down(lake):
    loaded = lake.raw.where(F.col("year") < 2000)
    fresh = incremental(lake.raw, loaded, "timestamp")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(timestamp," in plan and "PartitionFilters: [" in plan
    assert fresh.agg(F.min("year")).first()[0] == 2000
    nothing = incremental(lake.raw, lake.raw, "timestamp")
    assert nothing.count() == 0
    assert incremental(lake.raw, lake.raw.limit(0), "timestamp").count() == lake.raw.count()


@pytest.mark.parametrize("zone", ["America/Fortaleza", "Asia/Tokyo"])
def test_incremental_in_any_process_zone(lake, monkeypatch, zone):
    """Initial and increment together are the source, with ties at the mark and rows without instant."""
    instant = F.lit("2000-02-03 11:00:00").cast("timestamp_ntz")
    rows = lake.raw.withColumn("timestamp", F.when(F.col("transaction_id") % 50 == 0, instant).otherwise(F.col("timestamp")))
    rows = rows.drop(*MONTHLY)
    loaded = rows.where((F.col("timestamp") <= instant) & (F.col("transaction_id") % 100 != 0))
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        fresh = incremental(rows, loaded, "timestamp")
        late = rows.where((F.col("timestamp") > instant) | F.col("timestamp").isNull())
        tied = rows.where((F.col("timestamp") == instant) & (F.col("transaction_id") % 100 == 0))
        assert fresh.count() == late.count() + tied.count()
        assert fresh.exceptAll(late).exceptAll(tied).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_labels_with_months_prune_silver(lake):
    updated = apply_late_labels(lake.silver, loads.chargebacks(lake, 2001))
    plan = updated._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    silver = [line for line in scans if "(year#" in line.split("PartitionFilters:")[1].split("PushedFilters:")[0]]
    assert len(silver) >= 2, "both reads of Silver know the labels' months"
    assert not [line for line in scans if "is_fraud" in line and line not in silver]


def test_compaction_keeps_rows_and_reduces_files(lake):
    report = loads.compacted(lake).collect()
    assert all(r.linhas_antes == r.linhas_depois for r in report)
    assert sum(r.arquivos_depois for r in report) < sum(r.arquivos_antes for r in report)


def test_layer_sizes_cover_every_layer(lake):
    sizes = {r.camada: r for r in loads.sizes(lake).collect()}
    assert set(sizes) == set(loads.LAYER_FOLDERS)
    assert sizes["gold"].arquivos == 4
    assert all(r.bytes > 0 for r in sizes.values())


def test_enrichment_loses_nothing(lake):
    customers = lake.given("customer").where("c_acctbal >= 0").select(
        F.col("c_custkey").alias("customer_id"), "c_mktsegment"
    )
    joined = enrich_customer(lake.silver, customers)
    missing = orphans(lake.silver, customers).agg(F.sum("transacoes")).first()[0]
    assert joined.count() == lake.silver.count()
    assert joined.where("c_mktsegment IS NULL").count() == missing > 0


def test_history_of_a_dominant_customer(spark):
    """One customer owns most rows, many at the same instant."""
    df = spark.range(4000).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.col("id")).cast("long").alias("customer_id"),
        (F.expr("TIMESTAMP_NTZ '2025-03-01 00:00:00'")
         + F.make_dt_interval(secs=((F.col("id") % 500) * 60).cast("decimal(18,6)"))).alias("ts"),
        (F.col("id") % 7 == 0).alias("is_fraud"),
    )
    rows = [r.asDict() for r in df.collect()]
    got = {r.transaction_id: r for r in customer_history(df).collect()}
    assert len(got) == len(rows)
    mine = [r for r in rows if r["customer_id"] == 1]
    for r in mine[::97]:
        earlier = [e for e in mine if e["ts"] < r["ts"]]
        seen = got[r["transaction_id"]]
        assert seen.transacoes_previas == len(earlier)
        assert seen.fraudes_previas == sum(e["is_fraud"] for e in earlier)


def test_rolling_rate_counts_present_days(spark):
    days = [("2025-01-%02d" % d, 10, d % 3) for d in (1, 2, 3, 5, 8, 9, 10, 12)]
    daily = spark.createDataFrame(days, "d string, transacoes long, fraudes long").select(
        F.to_date("d").alias("data"), "transacoes", "fraudes"
    )
    got = [r.taxa_movel_pct for r in rolling_rate(daily).orderBy("data").collect()]
    assert got[:6] == [None] * 6
    f = [d[2] for d in days]
    assert got[6:] == [round(100 * sum(f[i - 6 : i + 1]) / 70, 4) for i in (6, 7)]


def test_weeks_above_needs_adjacent_weeks(spark):
    weeks = ["2025-01-06", "2025-01-13", "2025-01-27", "2025-02-03", "2025-02-10"]
    data = [("a", w, i < 5) for w in weeks for i in range(10)]
    data += [("b", w, False) for w in weeks for _ in range(10)]
    df = spark.createDataFrame(data, "channel string, d string, is_fraud boolean").select(
        "channel", F.to_date("d").alias("data"), "is_fraud"
    )
    runs = weeks_above(df, ["channel"], 3).collect()
    assert [(r.channel, str(r.inicio), str(r.fim), r.semanas) for r in runs] == [
        ("a", "2025-01-27", "2025-02-10", 3)
    ]


def test_single_mart_equals_the_combined_build(lake):
    for name, built in lake.marts().items():
        alone = mart(lake.silver, name).select(*built.columns)
        assert alone.exceptAll(built).count() == built.exceptAll(alone).count() == 0


def test_partitioned_writes_sort_nothing(spark, tmp_path, monkeypatch):
    """Tasks keep a file open per partition, and more partitions than files lose no row."""
    seen, parquet = [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        seen.append(spark.conf.get(layers.OPEN_FILES_SETTING))
        return parquet(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    before = spark.conf.get(layers.OPEN_FILES_SETTING)
    rows = spark.range(0, 5000, 1, 2).selectExpr("id", "id % 90 AS p")
    layers.write_layer(rows, str(tmp_path / "a"), ("p",), spread=False)
    assert seen == [str(layers.OPEN_FILES)] and spark.conf.get(layers.OPEN_FILES_SETTING) == before
    assert rows.exceptAll(spark.read.parquet(str(tmp_path / "a")).selectExpr("id", "CAST(p AS BIGINT) AS p")).count() == 0
    assert jobs.stream_session(spark).conf.get(layers.OPEN_FILES_SETTING) == str(layers.OPEN_FILES)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_what_a_layer_shuffles_leaves_the_disk(spark, lake):
    """Loads and compaction each give up what they shuffled once their files are written."""
    before = shuffle_files(spark)
    report = loads.compacted(lake)
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert sum(r.linhas_depois for r in report.collect()) == lake.raw.count()


def test_the_trial_of_rules_moves_no_rows_to_load_them(lake, tmp_path, monkeypatch):
    plans, parquet = {}, DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        plans[path] = self._df._jdf.queryExecution().executedPlan().toString()
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    trial = str(tmp_path / "falhas")
    tested = rule_matrix(lake, trial).collect()
    assert "Exchange" not in plans[f"{trial}/raw_particionada"]
    assert len(tested) == 12 and all(r.linhas == r.conformes for r in tested)
