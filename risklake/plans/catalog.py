"""Every query by name, as a function of a lake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.config import CLEAN_COLUMNS
from risklake.functions.numeric import round_half
from risklake.functions.text import label
from risklake.operators.enrich import enrich_customer, orphans
from risklake.operators.history import customer_history, month_over_month, weeks_above
from risklake.operators.metrics import conservation
from risklake.operators.quality import (
    attribute_consistency,
    flag_totals,
    quality_rules,
    rule_hits,
    time_granularity,
)
from risklake.operators.ranking import capture_top
from risklake.operators.smallcells import CELL
from risklake.plans import analyses, loads, model, panels
from risklake.plans.faults import rule_matrix
from risklake.plans.lakehouse import Lake
from risklake.sources import exports
from risklake.sources.layers import schema_report
from risklake.streaming import jobs

Query = Callable[[Lake], DataFrame]


# -- quality -----------------------------------------------------------------


def _label_parse(lake: Lake) -> DataFrame:
    counted = lake.raw.groupBy("is_fraud").agg(F.count("*").alias("linhas"))
    return counted.select(
        F.col("is_fraud").alias("texto"), label(F.col("is_fraud")).alias("rotulo"), "linhas"
    )


def _label_status(lake: Lake) -> DataFrame:
    return lake.bronze.groupBy("is_fraud", "status").agg(F.count("*").alias("linhas"))


def _survivors(flag: str) -> Query:
    return lambda lake: lake.marked().where(~F.col(flag)).drop(
        "repete_id", "repete_conteudo", "year", "month"
    )


# -- dimension joins ---------------------------------------------------------


def _registered_customers(lake: Lake) -> DataFrame:
    return lake.given("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("nacao"),
        F.col("c_mktsegment").alias("mercado"),
    )


def _facts_with_orphans(lake: Lake) -> DataFrame:
    """Silver in which every 17th customer number is one that no register has."""
    unknown = F.when(F.col("customer_id") % 17 == 0, -F.col("customer_id")).otherwise(F.col("customer_id"))
    return lake.silver.withColumn("customer_id", unknown)


def _enriched(lake: Lake) -> DataFrame:
    facts = _facts_with_orphans(lake).select("transaction_id", "customer_id", "is_fraud")
    return enrich_customer(facts, _registered_customers(lake)).select(
        "transaction_id", "customer_id", "is_fraud", "nacao", "mercado"
    )


# -- sinks -------------------------------------------------------------------


def _csv_result(lake: Lake) -> DataFrame:
    path, result = loads.fresh(lake, "resultado-csv"), analyses.by_segment(lake)
    exports.write_result_csv(result, path)
    return exports.read_result_csv(lake.spark, path, result.schema)


def _panel_json(lake: Lake) -> DataFrame:
    path, result = loads.fresh(lake, "painel-json"), panels.base_cube(lake.cube)
    exports.write_panel_json(result, path)
    return exports.read_panel_json(lake.spark, path, result.schema)


def _sql_view(lake: Lake) -> DataFrame:
    """A mart queried in SQL under its own name."""
    exports.register_views(lake.marts())
    return lake.spark.sql(
        """SELECT channel, sum(transacoes) AS transacoes, sum(fraudes) AS fraudes
           FROM gold_serie_diaria GROUP BY ALL ORDER BY ALL"""
    )


# -- streams -----------------------------------------------------------------


def _stream(lake: Lake, name: str, df: DataFrame, partitions: tuple[str, ...] = ()) -> DataFrame:
    out, checkpoint = loads.fresh(lake, name), loads.fresh(lake, f"{name}-progresso")
    jobs.run(df, out, checkpoint, partitions).awaitTermination()
    return lake.spark.read.schema(stored_schema(df)).parquet(out)


def stored_schema(df: DataFrame):
    """Stream schema as stored: zone-less event times."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType,
            )
            for f in df.schema.fields
        ]
    )


def _events(lake: Lake, session: SparkSession | None = None) -> DataFrame:
    """The given events as a stream. Written as a pattern, the path may name a
    single file (a plain stream path must be a folder) or a folder of files."""
    path = f"{lake.source}/events.parque[t]"
    return jobs.read_events(session or jobs.stream_session(lake.spark), path)


def _last_event(lake: Lake) -> str | None:
    return lake.given("events").agg(F.max("ts").cast("timestamp_ntz").cast("string")).first()[0]


def _ended_events(lake: Lake, name: str) -> DataFrame:
    """The given events as a stream, and the event that ends the feed.

    Both are files of the first micro-batch, which has no watermark, so the end event
    makes none of the others late; the batch after it finds all windows closed.
    """
    session, feed = jobs.stream_session(lake.spark), loads.fresh(lake, f"{name}-fim")
    given = lake.given("events")
    given.select(*[F.col(f.name).cast(f.dataType) for f in jobs.EVENT_SCHEMA.fields]).limit(0).write.parquet(feed)
    last = _last_event(lake)
    if last is not None:
        jobs.end_of_feed(lake.spark, last, feed)
    return _events(lake, session).unionByName(jobs.read_events(session, feed))


def _closed_windows(lake: Lake, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All windows of the feed: those open at its end are closed by an end-of-feed event."""
    return _stream(lake, name, build(_ended_events(lake, name)))


def _stream_recent(lake: Lake) -> DataFrame:
    """Purchases joined, as a stream, with the stream of hourly windows written as a feature table."""
    table, progress = loads.fresh(lake, "recentes"), loads.fresh(lake, "recentes-progresso")
    jobs.run(jobs.sliding(_ended_events(lake, "recentes-fonte")), table, progress).awaitTermination()
    events = _ended_events(lake, "compras-fonte")
    joined = jobs.with_recent(events, jobs.read_features(events.sparkSession, table))
    return _stream(lake, "compras-recentes", joined)


DELIVERIES = 4


def _deliveries(lake: Lake) -> DataFrame:
    """The given events by delivery: a quarter of their time span each, every 37th one delivery late."""
    given = lake.given("events")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    span = given.select(seconds.alias("s")).agg(F.min("s").alias("_from"), F.max("s").alias("_to"))
    part = F.floor((seconds - F.col("_from")) * DELIVERIES / (F.col("_to") - F.col("_from") + 1)).cast("int")
    late = (F.col("event_id") % 37 == 0) & (part < DELIVERIES - 1)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in jobs.EVENT_SCHEMA.fields]
    return given.join(F.broadcast(span)).select(*columns, F.when(late, part + 1).otherwise(part).alias("entrega"))


def _diverted(lake: Lake) -> str:
    """Folder of a feed delivered out of order, split into rows on time and late ones."""
    session, feed = jobs.stream_session(lake.spark), loads.fresh(lake, "entregas")
    out, progress = loads.fresh(lake, "desvio"), loads.fresh(lake, "desvio-progresso")
    events = _deliveries(lake)
    for k in range(DELIVERIES):
        events.where(F.col("entrega") == k).drop("entrega").write.mode("append").parquet(feed)
        jobs.diverted(jobs.read_events(session, feed), out, progress).awaitTermination()
    return out


def _stream_late(lake: Lake) -> DataFrame:
    """Events that came after their window had closed, and the mark they missed."""
    late = lake.spark.read.parquet(f"{_diverted(lake)}/atrasados")
    zoneless = {c: F.col(c).cast("timestamp_ntz") for c in ("ts", "marca")}
    return late.withColumns(zoneless).select("event_id", "ts", "user_id", "event_type", "marca", F.col("lote").cast("int").alias("entrega"))


def _stream_on_time(lake: Lake) -> DataFrame:
    """Windows of the feed's rows on time beside the rows it diverted: their sum is what came."""
    out = _diverted(lake)
    session = jobs.stream_session(lake.spark)
    windows, progress = loads.fresh(lake, "janelas-prazo"), loads.fresh(lake, "janelas-prazo-progresso")
    stream = jobs.tumbling(jobs.read_events(session, f"{out}/no_prazo"))
    jobs.run(stream, windows, progress).awaitTermination()
    last = _last_event(lake)
    if last is not None:
        jobs.end_of_feed(lake.spark, last, f"{out}/no_prazo/lote={DELIVERIES}")
        jobs.run(jobs.tumbling(jobs.read_events(session, f"{out}/no_prazo")), windows, progress).awaitTermination()
    closed = lake.spark.read.schema(stored_schema(stream)).parquet(windows)
    late = lake.spark.read.parquet(f"{out}/atrasados").select("user_id")
    kinds = closed.select("user_id", F.col("eventos").alias("no_prazo"), F.lit(0).alias("atrasados")).unionByName(
        late.select("user_id", F.lit(0).alias("no_prazo"), F.lit(1).alias("atrasados"))
    )
    return kinds.groupBy("user_id").agg(
        F.sum("no_prazo").alias("no_prazo"), F.sum("atrasados").alias("atrasados"),
        (F.sum("no_prazo") + F.sum("atrasados")).alias("entregues"),
    )


def _stream_land(lake: Lake) -> DataFrame:
    return _stream(lake, "eventos", jobs.landed(_events(lake)), ("dia",))


def _stream_dedup(lake: Lake) -> DataFrame:
    delivered = jobs.redelivered(_events(lake))
    return _stream(lake, "eventos-unicos", jobs.deduplicated(delivered))


def _layer_stream(lake: Lake, name: str) -> DataFrame:
    session = jobs.stream_session(lake.spark)
    return jobs.read_layer_stream(session, lake.path(name), lake.layer(name).schema)


def _stream_quality(lake: Lake) -> DataFrame:
    checked = jobs.checked(_layer_stream(lake, "raw_particionada"), lake.bounds)
    checked = checked.select(*CLEAN_COLUMNS, "motivo", "valida")
    return _stream(lake, "qualidade", checked, ("valida",))


def _stream_score(lake: Lake) -> DataFrame:
    scored = jobs.scored(_layer_stream(lake, "silver/transactions"), model.lake_model(lake))
    return _stream(lake, "escores", scored)


# -- model -------------------------------------------------------------------


def _features(lake: Lake) -> DataFrame:
    df = model.features(lake.silver)
    return df.select(
        "transaction_id",
        "label",
        *[c for c in model.FEATURES if c != "log_valor"],
        round_half(F.col("log_valor"), 6).alias("log_valor"),
    )


def _interaction(lake: Lake) -> DataFrame:
    glm = model.lake_glm(lake, interaction=True)
    return model.odds_ratios(lake.spark, glm, [*model.FEATURES, "app_x_viagem"])


def _capture_risk(lake: Lake) -> DataFrame:
    test = model.hash_split(lake.silver.select("transaction_id", "risk_score", "is_fraud"))[1]
    return capture_top(test, "risk_score", "transaction_id", "is_fraud")


APP = {"channel": "app"}
APP_TRAVEL = {"channel": "app", "merchant_category": "viagem"}
HIGH_NIGHT = {"segment": "High-Risk", "periodo_dia": "madrugada"}
MARCH = {"month": 3}

CATALOG: dict[str, Query] = {
    # sources and sinks
    "raw_scan": loads.csv_round_trip,
    "raw_rejects": loads.rejected_cells,
    "raw_multiline": loads.multiline_cells,
    "raw_multiline_rejects": loads.multiline_rejects,
    "landing_reconcile": loads.landing,
    "partition_counts": loads.partition_counts,
    "pruned_month": lambda lake: loads.one_month(lake, 1998, 3),
    "pruning_evidence": lambda lake: loads.pruning_evidence(lake, 1998, 3),
    "schema_report": lambda lake: schema_report(lake.silver),
    "layer_sizes": loads.sizes,
    "row_funnel": loads.funnel,
    "incremental_load": lambda lake: loads.incremental_load(lake, "2000-01-01 00:00:00"),
    "reprocess_month": lambda lake: loads.reprocess_months(lake, 2000, (2, 3)),
    "compact_partitions": loads.compacted,
    "csv_result": _csv_result,
    "panel_json": _panel_json,
    "sql_view": _sql_view,
    # cleaning and quality
    "stg_clean": lambda lake: lake.staged().select(*CLEAN_COLUMNS, "repete_id", "repete_conteudo"),
    "label_values": lambda lake: lake.raw.groupBy("is_fraud").agg(F.count("*").alias("linhas")),
    "label_parse": _label_parse,
    "dedup_id": _survivors("repete_id"),
    "dedup_content": _survivors("repete_conteudo"),
    "rule_hits": lambda lake: rule_hits(lake.staged(), quality_rules(lake.bounds)),
    "rule_matrix": lambda lake: rule_matrix(lake, loads.fresh(lake, "falhas")),
    "bronze": lambda lake: lake.bronze,
    "quarantine": lambda lake: lake.quarantine,
    "bronze_flags": lambda lake: flag_totals(lake.bronze),
    "label_x_status": _label_status,
    "segment_consistency": lambda lake: attribute_consistency(
        lake.bronze, ["customer_id"], "segment"
    ),
    "segment_consistency_by_channel": lambda lake: attribute_consistency(
        lake.bronze, ["customer_id", "channel"], "segment"
    ),
    "ts_granularity": lambda lake: time_granularity(lake.bronze),
    # Silver and Gold
    "silver": lambda lake: lake.silver,
    "gold_cubo_risco": lambda lake: lake.cube,
    "gold_serie_diaria": lambda lake: lake.mart("gold_serie_diaria"),
    "gold_perfil_horario": lambda lake: lake.mart("gold_perfil_horario"),
    "gold_segmento_score": lambda lake: lake.mart("gold_segmento_score"),
    "gold_conservation": lambda lake: conservation(lake.marts(), lake.silver),
    "gold_check_segment": analyses.segment_check,
    "enrich_customer": _enriched,
    "orphans": lambda lake: orphans(_facts_with_orphans(lake), _registered_customers(lake)),
    "late_labels": lambda lake: loads.late_labels(lake, 2001),
    "gold_after_labels": lambda lake: loads.labelled_cube(lake, 2001),
    "gold_after_labels_totals": lambda lake: loads.labelled_totals(lake, 2001),
    # published analyses
    "a0": lambda lake: analyses.overview(lake.cube),
    "a1a": analyses.by_segment,
    "a1b": analyses.by_credit_band,
    "a1c": analyses.mean_credit_by_segment,
    "a1d": analyses.by_segment_channel,
    "a2": analyses.by_channel,
    "a3a": analyses.by_category,
    "a3b": analyses.top_channel_category,
    "a4a": analyses.by_period,
    "a4b": analyses.by_hour,
    "a4c": analyses.by_weekday,
    "a4d": analyses.by_month,
    "a4e": analyses.app_travel_by_night,
    "a5a": analyses.by_risk_band,
    "a5b_auc": analyses.lone_auc,
    "a5b_chi2": analyses.credit_independence,
    "a5b_chi2_channel": analyses.channel_independence,
    "a5c": analyses.rule_simulation,
    "fraud_by_type": analyses.fraud_by_type,
    "auc_by_month": analyses.auc_by_month,
    "capture_by_month": analyses.capture_by_month,
    # panels
    "panel_cube": lambda lake: panels.base_cube(lake.cube),
    "panel_kpis": lambda lake: panels.kpis(lake.cube),
    "panel_kpis_app_viagem": lambda lake: panels.kpis(lake.cube, APP_TRAVEL),
    "panel_kpis_vazio": lambda lake: panels.kpis(lake.cube, {"month": 13}),
    "panel_monthly": lambda lake: panels.monthly(lake.cube, MARCH),
    "panel_monthly_app": lambda lake: panels.monthly(lake.cube, {**APP, **MARCH}),
    "rolling7_rate": lambda lake: panels.daily(lake.mart("gold_serie_diaria")),
    "rolling7_rate_app": lambda lake: panels.daily(lake.mart("gold_serie_diaria"), APP_TRAVEL),
    "rolling7_by_channel": lambda lake: panels.daily_by_channel(lake.mart("gold_serie_diaria")),
    "panel_bars_channel": lambda lake: panels.bars(lake.cube, "channel"),
    "panel_bars_channel_app_viagem": lambda lake: panels.bars(lake.cube, "channel", APP_TRAVEL),
    "panel_bars_category": lambda lake: panels.bars(lake.cube, "merchant_category", APP),
    "panel_bars_segment": lambda lake: panels.bars(lake.cube, "segment", MARCH),
    "panel_heat_channel_category": lambda lake: panels.heat_channel_category(lake.cube, APP),
    "panel_heat_channel_category_night": lambda lake: panels.heat_channel_category(
        lake.cube, {**HIGH_NIGHT, **MARCH}
    ),
    "panel_heat_hour_dow": lambda lake: panels.heat_hour_weekday(
        lake.mart("gold_perfil_horario"), lake.cube
    ),
    "panel_smallcell_rollup": lambda lake: panels.small_cells(lake.cube, min_n=50),
    "panel_smallcell_rollup_100": lambda lake: panels.small_cells(lake.cube, min_n=100),
    "panel_smallcell_rollup_200": lambda lake: panels.small_cells(lake.cube, min_n=200),
    "panel_smallcell_rollup_app": lambda lake: panels.small_cells(lake.cube, APP, 100),
    "capture_curve": lambda lake: panels.curve(lake.cube, min_n=100),
    "capture_curve_madrugada": lambda lake: panels.curve(lake.cube, HIGH_NIGHT, 30),
    "panel_cutoff": lambda lake: panels.cut(lake.cube),
    "panel_cutoff_5_app": lambda lake: panels.cut(lake.cube, APP, 30, 5),
    "panel_table": lambda lake: panels.review_table(lake.cube),
    "panel_table_app": lambda lake: panels.review_table(
        lake.cube, APP, 100, 10, "transacoes", False
    ),
    "engine_point": lambda lake: panels.engine_point(
        lake.mart("gold_segmento_score"), lake.cube
    ),
    "risk_cube_all": lambda lake: panels.every_slice(lake.cube),
    # history
    "mom_rate": lambda lake: month_over_month(lake.cube),
    "weeks_above": lambda lake: weeks_above(lake.silver, CELL, 2),
    "weeks_above_channel_segment": lambda lake: weeks_above(
        lake.silver, ("channel", "segment"), 3
    ),
    "customer_history_pit": lambda lake: customer_history(lake.silver),
    # model
    "ml_features": _features,
    "ml_split": lambda lake: model.split_summary(lake.silver),
    "ml_score": model.scored_silver,
    "ml_metrics": lambda lake: model.evaluation(model.scored_test(lake)),
    "odds_ratios": lambda lake: model.odds_ratios(lake.spark, model.lake_glm(lake)),
    "ml_interaction": _interaction,
    "ml_score_balance": model.score_certificate,
    "odds_ratios_check": model.odds_ratios_check,
    "ml_cv": lambda lake: model.cross_validated(model.feature_table(lake)),
    "capture_top_risk": _capture_risk,
    "capture_top_model": lambda lake: capture_top(
        model.scored_test(lake), "p_fraude", "transaction_id", "is_fraud"
    ),
    # streams
    "stream_land": _stream_land,
    "stream_tumbling": lambda lake: _closed_windows(lake, "janelas", jobs.tumbling),
    "stream_sliding": lambda lake: _closed_windows(lake, "deslizantes", jobs.sliding),
    "stream_recent": _stream_recent,
    "stream_dedup": _stream_dedup,
    "stream_late": _stream_late,
    "stream_on_time": _stream_on_time,
    "stream_quality": _stream_quality,
    "stream_score": _stream_score,
}
