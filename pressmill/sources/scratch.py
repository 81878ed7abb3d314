"""Tables written between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under spark.checkpoint.dir; under a temporary one where that is unset (local sessions, tests)."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _own = _own or tempfile.mkdtemp(prefix="pressmill-")
        base = f"file://{_own}"
    return f"{base.rstrip('/')}/pressmill/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The rows, written as Parquet and read back: lineage ends there, and lost executors cost a task at most."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete what written() wrote, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
