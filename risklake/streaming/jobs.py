"""Structured Streaming jobs.

Each job reads a folder of files as a stream, processes what is available and
stops (the same definitions run continuously under another trigger). State and
progress live in the checkpoint folder; sinks are Parquet, so a restarted job
neither loses nor repeats rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from risklake.config import RuleBounds
from risklake.functions.numeric import cents
from risklake.operators.quality import evaluate, quality_rules, stage
from risklake.plans.model import features, score
from risklake.sources.layers import OPEN_FILES, OPEN_FILES_SETTING

DELAY = "10 minutes"

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful jobs.

    The number of state partitions is fixed when a checkpoint is first written:
    size ``partitions`` for the state the job will hold, not for the machines at
    hand. Without it the session's shuffle partitions count. Event times are UTC.
    """
    session = spark.newSession()
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(wanted))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(OPEN_FILES_SETTING, str(OPEN_FILES))
    return session


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events with a zoned event time, which watermarks require."""
    events = spark.readStream.schema(EVENT_SCHEMA).parquet(path)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def run(
    df: DataFrame,
    out: str,
    checkpoint: str,
    partitions: tuple[str, ...] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append to a Parquet folder; event times are stored zone-less, as in batch."""
    stored = df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    writer = stored.writeStream.format("parquet").outputMode("append")
    if partitions:
        writer = writer.partitionBy(*partitions)
    return (
        writer.option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def landed(events: DataFrame) -> DataFrame:
    """Events as they arrive, plus the calendar day they are filed under."""
    return events.withColumn("dia", F.to_date("ts"))


def _per_ten_minutes(events: DataFrame) -> DataFrame:
    bought = F.col("event_type") == "purchase"
    return (
        events.withWatermark("ts", DELAY)
        .groupBy(F.window("ts", "10 minutes").alias("_w"), "user_id")
        .agg(
            F.count("*").alias("eventos"),
            F.count_if(bought).alias("compras"),
            F.sum(F.when(bought, cents(F.col("value"))).otherwise(F.lit(0))).alias(
                "centavos_compras"
            ),
        )
    )


def _named(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.col("_w.start").alias("inicio"),
        F.col("_w.end").alias("fim"),
        "user_id",
        "eventos",
        "compras",
        "centavos_compras",
    )


def tumbling(events: DataFrame) -> DataFrame:
    """Per-client activity in 10-minute windows."""
    return _named(_per_ten_minutes(events))


def sliding(events: DataFrame) -> DataFrame:
    """Per-client activity of the last hour, refreshed every 10 minutes.

    An hour adds up six 10-minute windows, so each event is aggregated once.
    """
    measures = ("eventos", "compras", "centavos_compras")
    tens = _per_ten_minutes(events).select(F.window_time("_w").alias("_t"), "user_id", *measures)
    hours = tens.groupBy(F.window("_t", "1 hour", "10 minutes").alias("_w"), "user_id")
    return _named(hours.agg(*[F.sum(m).alias(m) for m in measures]))


FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("inicio", T.TimestampNTZType()),
        T.StructField("fim", T.TimestampNTZType()),
        *[T.StructField(c, T.LongType()) for c in ("user_id", "eventos", "compras", "centavos_compras")],
    ]
)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The hourly windows that `sliding` writes, as a stream."""
    windows = spark.readStream.schema(FEATURE_SCHEMA).parquet(path)
    return windows.withColumns({c: F.col(c).cast("timestamp") for c in ("inicio", "fim")})


def with_recent(events: DataFrame, windows: DataFrame) -> DataFrame:
    """Purchases with their user's activity in the last hour's window that ended at or before them.

    An interval join of two streams: every ten minutes a window ends, so at most one
    lies within ten minutes before a purchase. State on both sides is dropped behind
    the older of the two watermarks; a purchase that waits in vain has no activity and
    gets zeros. Events without a user meet no window. The row that ends a feed (no type,
    no user) takes part, as it moves the watermark on, and is left out of the result by
    a condition on both sides, which is not pushed below the watermark. An hour's last
    windows end long after its events, so the windows need no such row.
    """
    bought = events.withWatermark("ts", DELAY).where("event_type = 'purchase' OR (event_type IS NULL AND user_id IS NULL)")
    recent = windows.withWatermark("fim", DELAY).withColumnRenamed("user_id", "_user")
    near = (F.col("user_id") == F.col("_user")) & (F.col("ts") >= F.col("fim")) & (F.col("ts") < F.col("fim") + F.expr("INTERVAL 10 MINUTES"))
    return bought.join(recent, near, "left").where("event_type IS NOT NULL OR _user IS NOT NULL").select(
        "event_id", "ts", "user_id", cents(F.col("value")).alias("centavos"),
        *[F.coalesce(c, F.lit(0)).alias(f"{c}_1h") for c in ("eventos", "compras", "centavos_compras")],
    )


def end_of_feed(spark: SparkSession, last: object, folder: str) -> None:
    """Append one event two days after the last, which closes every window before it.

    Its own windows stay open and are never written.
    """
    end = F.lit(str(last)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(2))
    row = spark.range(1).select(
        *[(end if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields]
    )
    row.write.mode("append").parquet(folder)


def _finished(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def diverted(
    events: DataFrame, out: str, checkpoint: str, window: str = "10 minutes", trigger: dict | None = None
) -> StreamingQuery:
    """File every event as on time or late; none vanishes.

    An event is late if its window had closed before its batch: if it ends no later
    than the latest event time of all earlier batches less DELAY. Windowed jobs read
    ``out``/no_prazo, in which no row lies behind their watermark; late rows stand in
    ``out``/atrasados with the mark they missed. Both are keyed by batch id, and a
    batch that is repeated after a failure writes only what it had not finished.
    """

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark, earlier = (f"{out}/marcas/lote={n}" for n in (number, number - 1))
        before = spark.read.parquet(earlier).first()["ate"] if _finished(spark, earlier) else None
        rows = batch.persist()
        if not _finished(spark, mark):
            top = F.greatest(F.max("ts"), F.lit(before).cast("timestamp"))
            rows.agg(top.alias("ate")).write.mode("overwrite").parquet(mark)
        closed = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {DELAY}")
        late = F.coalesce(F.window("ts", window)["end"] <= closed, F.lit(False))
        told = rows.withColumn("_late", late)
        for name, picked in (("no_prazo", told.where(~F.col("_late"))), ("atrasados", told.where("_late").withColumn("marca", closed))):
            folder = f"{out}/{name}/lote={number}"
            if not _finished(spark, folder):
                picked.drop("_late").write.mode("overwrite").parquet(folder)
        rows.unpersist()

    return (
        events.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def deduplicated(events: DataFrame) -> DataFrame:
    """First delivery of each event id; state is dropped past the watermark."""
    return events.withWatermark("ts", DELAY).dropDuplicatesWithinWatermark(["event_id"])


def redelivered(events: DataFrame) -> DataFrame:
    """Purchases delivered twice, as an at-least-once feed would."""
    copies = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return events.select("*", F.explode(copies).alias("_entrega")).drop("_entrega")


def checked(raw: DataFrame, bounds: RuleBounds) -> DataFrame:
    """Row-level quality rules on a stream; duplicates are handled separately.

    Valid and rejected rows share one sink, told apart by ``valida``.
    """
    rules = {n: c for n, c in quality_rules(bounds).items() if not n.startswith("duplicata")}
    evaluated = evaluate(stage(raw), rules)
    return evaluated.drop("repete_id", "repete_conteudo").withColumn(
        "valida", F.col("motivo") == ""
    )


def scored(silver: DataFrame, model: PipelineModel) -> DataFrame:
    """Fraud probability per arriving transaction, with the batch model."""
    return score(model, features(silver)).select("transaction_id", "p_fraude")


def read_layer_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
