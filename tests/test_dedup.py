"""Duplicate marks against a brute-force ranking, with heavily skewed keys."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from risklake.operators import dedup
from risklake.operators.dedup import Check, duplicate_marks, with_marks
from risklake.sources.layers import INGEST_ID, compact, write_numbered

SCHEMA = "k bigint, v int, pos int"
CHECKS = {"rep_k": Check(("k",), ("v",)), "rep_v": Check(("v",), ("k",))}


def brute(data, key, order):
    """Positions of all rows that are not the first of their group."""
    first = {}
    for row in data:
        rank = (row[order] is None, row[order] or 0, row[2])
        if row[key] not in first or rank < first[row[key]]:
            first[row[key]] = rank
    keep = {r[2] for r in first.values()}
    return {row[2] for row in data} - keep


def marks_of(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return {
        r.pos: (r.rep_k, r.rep_v)
        for r in duplicate_marks(df, CHECKS, address=("pos",)).collect()
    }


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.integers(0, 3))
        ),
        min_size=1,
        max_size=40,
    )
)
def test_matches_brute_force(spark, pairs):
    data = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    by_k, by_v = brute(data, 0, 1), brute(data, 1, 0)
    expected = {p: (p in by_k, p in by_v) for p in by_k | by_v}
    assert marks_of(spark, data) == expected


def test_hot_null_key_keeps_exactly_one_row(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("k"),
        F.col("id").cast("int").alias("v"),
        F.col("id").cast("int").alias("pos"),
    )
    marks = duplicate_marks(df, {"rep_k": CHECKS["rep_k"]}, address=("pos",))
    assert marks.count() == 999
    assert marks.where("pos = 0").count() == 0


def test_rows_with_a_value_come_before_rows_without(spark):
    """The dated copy of an id and the copy with an id of a content are the ones kept."""
    data = [(1, None, 0), (1, 7, 1), (None, 5, 2), (4, 5, 3)]
    assert marks_of(spark, data) == {0: (True, False), 2: (False, True)}


def test_marks_join_by_measured_size(spark):
    df = spark.range(200).select(
        (F.col("id") % 150).alias("k"),
        F.lit(1).alias("v"),
        F.col("id").cast("int").alias("pos"),
    )
    check = {"rep_k": CHECKS["rep_k"]}
    marks = duplicate_marks(df, check, address=("pos",))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    counts = set()
    try:
        for most in ("10m", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            counts.add(with_marks(df, marks, check, ("pos",)).where("rep_k").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert counts == {50}


def test_marks_survive_compaction_and_a_moved_lake(spark, lake, tmp_path):
    """Numbers are unique, stored with the rows, and tell duplicates apart wherever the files lie."""
    raw, marks = lake.layer("raw_particionada"), lake.layer("work/duplicatas")
    assert raw.select(INGEST_ID).distinct().count() == raw.count() and raw.where(f"{INGEST_ID} IS NULL").count() == 0
    moved, marks_moved = str(tmp_path / "movido/raw"), str(tmp_path / "movido/marcas")
    compact(spark, lake.path("raw_particionada"), moved)
    marks.coalesce(1).write.parquet(marks_moved)
    after = with_marks(spark.read.parquet(moved), spark.read.parquet(marks_moved))
    flags = ["transaction_id", "repete_id", "repete_conteudo"]
    assert after.where("repete_id").count() > 0 and after.where("repete_conteudo").count() > 0
    assert after.select(*flags).exceptAll(lake.marked().select(*flags)).count() == 0
    assert after.count() == lake.marked().count()


def test_later_loads_are_numbered_above_earlier_ones(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).selectExpr("id", "2024 AS year", "CAST(1 + id % 3 AS INT) AS month")
    write_numbered(rows, str(tmp_path / "a"))
    top = spark.read.parquet(str(tmp_path / "a")).agg({INGEST_ID: "max"}).first()[0]
    write_numbered(rows, str(tmp_path / "b"), after=top)
    both = spark.read.parquet(str(tmp_path / "a")).unionByName(spark.read.parquet(str(tmp_path / "b")))
    assert both.select(INGEST_ID).distinct().count() == 2000
    assert spark.read.parquet(str(tmp_path / "b")).where(f"{INGEST_ID} <= {top}").count() == 0


def test_rows_stay_where_they_are_however_large_the_tables(spark, lake, monkeypatch):
    """Beyond the planner's broadcast size both joins moved every whole row."""
    flags = ["transaction_id", "repete_id", "repete_conteudo"]
    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), lake.marked().select(*flags)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = lake.marked()._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == plan.count("BroadcastExchange") > 0
        monkeypatch.setattr(dedup, "BROADCAST_BLOCKS", 0)
        assert before.exceptAll(lake.marked().select(*flags)).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_hashes_shared_by_chance_change_no_mark(spark, monkeypatch):
    data = [(i % 7000, i % 9000, i) for i in range(10000)]
    expected = marks_of(spark, data)
    assert sum(k for k, _ in expected.values()) == 3000 and sum(v for _, v in expected.values()) == 1000
    monkeypatch.setattr(dedup, "HASH_BITS", 8)
    assert marks_of(spark, data) == expected
