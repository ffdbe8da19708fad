"""Streams: late rows, restarts, and agreement with batch."""

import pytest
from pyspark.sql import functions as F

from risklake.streaming import jobs


@pytest.fixture()
def feed(spark, tmp_path):
    """Writes batches of events (id, minute of 2024-01-01, user, type) as files."""
    folder = str(tmp_path / "eventos")
    start = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")

    def write(rows):
        df = spark.createDataFrame(rows, "event_id long, m int, user_id long, event_type string")
        df.select(
            "event_id",
            (start + F.make_dt_interval(mins="m")).alias("ts"),
            "user_id",
            "event_type",
            F.lit(1.5).alias("value"),
            F.lit("{}").alias("props"),
        ).coalesce(1).write.mode("append").parquet(folder)

    return folder, write


def drain(spark, folder, tmp_path, build):
    out, progress = str(tmp_path / "saida"), str(tmp_path / "progresso")
    stream = jobs.read_events(jobs.stream_session(spark), folder)
    jobs.run(build(stream), out, progress).awaitTermination()
    return spark.read.parquet(out)


def test_rows_behind_the_watermark_are_dropped(spark, feed, tmp_path):
    folder, write = feed
    write([(1, 1, 7, "view"), (2, 60, 7, "purchase")])
    first = drain(spark, folder, tmp_path, jobs.tumbling)
    assert [(r.eventos, r.compras) for r in first.collect()] == [(1, 0)]
    # minute 2 belongs to a closed window; minute 58 is late but within the delay
    write([(3, 2, 7, "purchase"), (4, 58, 7, "purchase"), (5, 120, 7, "view")])
    after = drain(spark, folder, tmp_path, jobs.tumbling)
    got = {str(r.inicio)[11:16]: r.eventos for r in after.collect()}
    assert got == {"00:00": 1, "00:50": 1, "01:00": 1}


def test_restart_neither_loses_nor_repeats(spark, feed, tmp_path):
    folder, write = feed
    write([(i, i, 1, "view") for i in range(5)])
    assert drain(spark, folder, tmp_path, jobs.landed).count() == 5
    assert drain(spark, folder, tmp_path, jobs.landed).count() == 5
    write([(i, i, 1, "view") for i in range(5, 9)])
    assert drain(spark, folder, tmp_path, jobs.landed).count() == 9


def test_redelivery_across_batches_is_removed(spark, feed, tmp_path):
    folder, write = feed
    write([(1, 0, 1, "purchase"), (2, 1, 1, "view")])
    assert drain(spark, folder, tmp_path, lambda e: jobs.deduplicated(jobs.redelivered(e))).count() == 2
    write([(1, 2, 1, "purchase"), (3, 3, 1, "view")])
    out = drain(spark, folder, tmp_path, lambda e: jobs.deduplicated(jobs.redelivered(e)))
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3]


def test_sliding_hour_sees_recent_purchases(spark, feed, tmp_path):
    folder, write = feed
    write([(1, 5, 1, "purchase"), (2, 35, 1, "purchase"), (3, 300, 2, "view")])
    out = drain(spark, folder, tmp_path, jobs.sliding).where("user_id = 1")
    by_end = {str(r.fim)[11:16]: r.compras for r in out.collect()}
    assert by_end["00:40"] == 2 and by_end["01:00"] == 2 and by_end["01:10"] == 1
    assert out.agg(F.max("centavos_compras")).first()[0] == 300


def test_stream_rules_equal_batch_rules(spark, lake, tmp_path):
    from risklake.plans.catalog import CATALOG

    checked = CATALOG["stream_quality"](lake)
    assert checked.count() == lake.raw.count()
    assert checked.where("valida").count() >= lake.bronze.count()
    assert checked.where("motivo LIKE '%duplicata%'").count() == 0


def test_end_of_feed_closes_all_windows_in_any_file_order(spark, feed, tmp_path):
    """Rows in equal rows out: nothing stays open, whatever order the minutes arrive in within a batch."""
    folder, write = feed
    write([(1, 50, 7, "view"), (2, 3, 7, "purchase")])
    write([(3, 41, 8, "view"), (4, 59, 7, "view")])
    assert drain(spark, folder, tmp_path, jobs.tumbling).count() < 4
    jobs.end_of_feed(spark, "2024-01-01 00:59:00", folder)
    rows = drain(spark, folder, tmp_path, jobs.tumbling).collect()
    assert sum(r.eventos for r in rows) == 4 and len(rows) == 3


def test_late_rows_are_diverted_and_batches_repeatable(spark, feed, tmp_path):
    folder, write = feed
    out, progress = str(tmp_path / "desvio"), str(tmp_path / "progresso")

    def deliver(rows):
        write(rows)
        jobs.diverted(jobs.read_events(jobs.stream_session(spark), folder), out, progress).awaitTermination()

    def ids(name):
        return sorted(r.event_id for r in spark.read.parquet(f"{out}/{name}").collect())

    deliver([(1, 1, 7, "view"), (2, 60, 7, "purchase")])
    deliver([(3, 2, 7, "purchase"), (4, 58, 7, "view"), (5, 120, 7, "view")])
    deliver([(6, 59, 8, "view"), (7, 112, 8, "view"), (8, 130, 8, "view")])
    assert ids("no_prazo") == [1, 2, 4, 5, 7, 8] and ids("atrasados") == [3, 6]
    marks = {r.event_id: str(r.marca)[11:16] for r in spark.read.parquet(f"{out}/atrasados").collect()}
    assert marks == {3: "00:50", 6: "01:50"}
    # A windowed job over the rows on time drops none of them.
    windows = drain(spark, f"{out}/no_prazo", tmp_path / "janelas", jobs.tumbling)
    jobs.end_of_feed(spark, "2024-01-01 03:00:00", f"{out}/no_prazo/lote=99")
    windows = drain(spark, f"{out}/no_prazo", tmp_path / "janelas", jobs.tumbling)
    assert sum(r.eventos for r in windows.collect()) == 6


def test_interval_join_over_several_batches_keeps_every_purchase(spark, feed, tmp_path):
    """Windows that come after their purchases still meet them; purchases without one get zeros."""
    folder, write = feed
    table, out = str(tmp_path / "janelas"), str(tmp_path / "saida")
    session = jobs.stream_session(spark)

    def advance():
        windows = jobs.sliding(jobs.read_events(session, folder))
        jobs.run(windows, table, str(tmp_path / "p1")).awaitTermination()
        joined = jobs.with_recent(jobs.read_events(session, folder), jobs.read_features(session, table))
        jobs.run(joined, out, str(tmp_path / "p2")).awaitTermination()

    write([(1, 5, 7, "purchase"), (2, 12, 7, "purchase"), (3, 20, 8, "purchase")])
    advance()
    write([(4, 65, 7, "purchase"), (5, 64, 7, "view"), (6, 75, 7, "purchase"), (7, 40, None, "purchase")])
    advance()
    jobs.end_of_feed(spark, "2024-01-01 01:15:00", folder)
    advance()
    got = {r.event_id: (r.eventos_1h, r.compras_1h) for r in spark.read.parquet(out).collect()}
    assert got == {1: (0, 0), 2: (1, 1), 3: (0, 0), 4: (2, 2), 6: (3, 2), 7: (0, 0)}
