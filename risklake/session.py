"""Session settings and the shared work folder."""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}
_TABLE = itertools.count(1)
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "risklake", **conf) -> SparkSession:
    """A session with the settings the jobs are planned for.

    On a cluster leave ``master`` to spark-submit and raise
    ``spark.sql.shuffle.partitions`` to the initial parallelism wanted; adaptive
    execution coalesces small partitions and splits skewed ones at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # Larger generated methods are never JIT-compiled; plain evaluation is faster.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables, private to this application.

    Taken from ``spark.checkpoint.dir``, which every executor can reach. Only a
    local-mode session may fall back to a temporary folder.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _LOCAL_FALLBACK.setdefault(app, tempfile.mkdtemp(prefix="risklake-"))
    return f"{base.rstrip('/')}/risklake/{app}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, a write's shuffle files go as soon as it has ended.

    By default they stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)


def written(df: DataFrame, name: str, gather: bool = False) -> DataFrame:
    """The same rows as a table in the work folder.

    Used where a result feeds several branches that must agree: it is computed
    once, survives lost executors, and its readers see one fixed version.
    ``gather`` rebalances first, for few rows filtered out of many input files.
    """
    path = f"{work_dir(df.sparkSession)}/tabelas/{name}-{next(_TABLE)}"
    (df.hint("rebalance") if gather else df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
