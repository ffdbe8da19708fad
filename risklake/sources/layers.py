"""Parquet layers: partitioned writes, row addresses, reprocessing, audits."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.session import shuffles_dropped

MONTHLY = ("year", "month")
INGEST_ID = "ingest_id"
ROW_ADDRESS = (INGEST_ID,)

#: Files that a task writes at once; rows of further partitions are sorted first.
OPEN_FILES = 32
OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def several_files(spark: SparkSession) -> Iterator[None]:
    """Within it, a task of a partitioned write keeps a file open per partition.

    By default it sorts all its rows by partition first, in memory or, beyond that, in spills,
    although they come nearly in that order.
    """
    before = spark.conf.get(OPEN_FILES_SETTING)
    spark.conf.set(OPEN_FILES_SETTING, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES_SETTING, before)


def with_month(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.select("*", F.year(ts).alias("year"), F.month(ts).alias("month"))


def write_layer(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = (),
    spread: bool = True,
    dynamic: bool = False,
) -> None:
    """Overwrite a layer, optionally partitioned.

    ``spread`` asks adaptive execution to rebalance by the partition columns:
    small partitions are merged into few files and a partition holding a large
    share of the rows is split over many tasks. Pass ``spread=False`` when the
    input already arrives file-by-file in partition order, which saves the
    shuffle. ``dynamic`` replaces only the partitions present in ``df``. What was
    shuffled for a layer leaves the disk once it is written.
    """
    out = df.hint("rebalance", *partitions) if spread else df
    writer = out.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with several_files(df.sparkSession), shuffles_dropped(df.sparkSession):
        writer.parquet(path)


def write_small(df: DataFrame, path: str) -> None:
    """One file, for marts whose size is bounded by their key domains."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def append_layer(df: DataFrame, path: str, partitions: Sequence[str] = MONTHLY) -> None:
    with several_files(df.sparkSession), shuffles_dropped(df.sparkSession):
        df.hint("rebalance", *partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_numbered(df: DataFrame, path: str, after: int = -1, spread: bool = True) -> None:
    """Write rows by month with an ``ingest_id`` above ``after``, unique among them.

    The number is the writing task's place and the row's place in it, taken after rows
    are spread and stored with them: it needs no count or sort, is fixed once written,
    and goes with its row through compaction, copies and moved lakes. A later load
    passes the largest number so far; each takes up 2^33 numbers per task. ``spread``
    as for `write_layer`.
    """
    rows = df.hint("rebalance", *MONTHLY) if spread else df
    numbered = rows.withColumn(INGEST_ID, F.lit(after + 1).cast("bigint") + F.monotonically_increasing_id())
    write_layer(numbered, path, MONTHLY, spread=False)


def reprocess(df: DataFrame, path: str) -> None:
    """Replace only the month partitions that occur in ``df``."""
    write_layer(df, path, MONTHLY, dynamic=True)


def compact(spark: SparkSession, src: str, dst: str, partitions: Sequence[str] = MONTHLY) -> None:
    """Rewrite a fragmented layer with few, evenly sized files per partition."""
    write_layer(read_layer(spark, src), dst, partitions)


def file_report(spark: SparkSession, path: str, partitions: Sequence[str] = MONTHLY) -> DataFrame:
    """Files and rows per partition, from the scan's own metadata."""
    return (
        spark.read.parquet(path)
        .groupBy(*partitions, F.col("_metadata.file_path").alias("arquivo"))
        .agg(F.count("*").alias("linhas"))
        .groupBy(*partitions)
        .agg(F.count("*").alias("arquivos"), F.sum("linhas").alias("linhas"))
    )


def layer_sizes(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Files and bytes per layer; only listing columns are read, never content."""
    parts = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(root)
        .select(F.lit(name).alias("camada"), "length")
        for name, root in roots.items()
    ]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("camada").agg(
        F.count("*").alias("arquivos"), F.sum("length").alias("bytes")
    )


def row_funnel(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer, in the order given, with its row count."""
    counts = [
        df.agg(F.count("*").alias("linhas")).select(
            F.lit(i).alias("ordem"), F.lit(name).alias("camada"), "linhas"
        )
        for i, (name, df) in enumerate(layers.items(), start=1)
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and filled-value count of each column, in one pass."""
    row = F.array(
        *[
            F.struct(
                F.lit(i).alias("posicao"),
                F.lit(f.name).alias("coluna"),
                F.lit(f.dataType.simpleString()).alias("tipo"),
                F.count(F.col(f.name)).alias("preenchidas"),
            )
            for i, f in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(row.alias("r")).select(F.inline("r"))
