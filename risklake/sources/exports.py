"""Result sinks: CSV, JSON and a relational store for the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_result_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_result_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_panel_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_panel_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def export_mart(df: DataFrame, url: str, table: str, writers: int = 4, **properties: str) -> None:
    """Replace a mart in a relational database, keeping its table definition."""
    df.coalesce(writers).write.option("truncate", True).jdbc(
        url, table, mode="overwrite", properties=properties
    )


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose layers and marts to SQL under their own names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
