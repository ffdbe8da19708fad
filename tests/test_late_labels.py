import glob

from pyspark.sql import functions as F

from tests.conftest import rows
from risklake.config import MARTS
from risklake.operators.labels import apply_late_labels, label_changes
from risklake.operators.metrics import mart, mart_deltas, merged_mart
from risklake.plans import loads
from risklake.sources.layers import MONTHLY, write_layer


def test_labels_with_another_month_or_none_are_applied(spark):
    silver = spark.createDataFrame(
        [("a", 0, 2024, 1), ("b", 0, 2024, 2), ("c", 0, 2024, 3), ("d", 0, 2024, 4)],
        "transaction_id string, is_fraud int, year int, month int",
    )
    labels = spark.createDataFrame(
        [("a", 1, 1, 2024, 1), ("b", 1, 1, 2024, 1), ("c", 1, 1, None, None)],
        "transaction_id string, is_fraud int, rotulado_em int, year int, month int",
    )
    got = {r.transaction_id: r.is_fraud for r in apply_late_labels(silver, labels).collect()}
    assert got == {"a": 1, "b": 1, "c": 1}


def test_deltas_equal_a_rebuild(spark, lake):
    """Labels set and cleared: every mart moved by deltas holds what a rebuild holds."""
    labels = loads.corrections(lake, 2001)
    assert {r.is_fraud for r in labels.select("is_fraud").distinct().collect()} == {True, False}
    last = labels.groupBy("transaction_id").agg(F.max_by("is_fraud", "rotulado_em").alias("_r"))
    relabelled = lake.silver.join(last, "transaction_id", "left").withColumn("is_fraud", F.coalesce("_r", "is_fraud"))
    deltas = mart_deltas(label_changes(lake.silver, labels))
    moved = 0
    for name in MARTS:
        got = rows(merged_mart(lake.mart(name), deltas, name))
        assert got == rows(mart(relabelled, name).select(*lake.mart(name).columns))
        moved += got != rows(lake.mart(name))
    assert moved == len(MARTS)


def test_deltas_of_other_rows_empty_labels_and_emptied_groups(spark, lake):
    none = label_changes(lake.silver, loads.corrections(lake, 1901))
    assert none.count() == 0
    name = "gold_serie_diaria"
    assert rows(merged_mart(lake.mart(name), mart_deltas(none), name)) == rows(lake.mart(name))
    gone = lake.silver.where("channel = 'atm'").withColumn("sinal", F.lit(-1))
    left = merged_mart(lake.mart(name), mart_deltas(gone), name)
    assert rows(left) == rows(lake.mart(name).where("channel <> 'atm'"))


def test_months_without_a_label_are_not_read(spark, lake, tmp_path):
    """Files of all other months are made unreadable; the changes still come out."""
    path = str(tmp_path / "silver")
    write_layer(lake.silver, path, MONTHLY)
    one = lake.silver.where("year = 2000 AND month = 5").orderBy("transaction_id").first()
    for file in glob.glob(f"{path}/year=*/month=*/*.parquet"):
        if "/year=2000/month=5/" not in file:
            with open(file, "wb") as out:
                out.write(b"no parquet")
    silver = spark.read.schema(lake.silver.schema).parquet(path)
    labels = spark.createDataFrame(
        [(one.transaction_id, not one.is_fraud, 1, 2000, 5)],
        "transaction_id long, is_fraud boolean, rotulado_em int, year int, month int",
    )
    got = {(r.transaction_id, r.is_fraud, r.sinal) for r in label_changes(silver, labels).collect()}
    assert got == {(one.transaction_id, one.is_fraud, -1), (one.transaction_id, not one.is_fraud, 1)}
