"""Written intermediate tables that are deleted once nothing reads them any more."""

from __future__ import annotations

from pyspark.sql import DataFrame

from risklake.session import shuffles_dropped, written

__all__ = ["dropped", "kept", "shuffles_dropped"]


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared work folder."""
    return written(df, f"llm-{name}")


def dropped(*tables: DataFrame) -> None:
    """Delete the files of written tables; call when all their readers have been written."""
    for df in tables:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
