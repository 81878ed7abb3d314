"""Incremental runs: file streams that stop when all that is there is done, a status table, and windows over events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def process_new_files(spark: SparkSession, folder: str, schema: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Run `step` over Parquet files that have come since the last run and append its rows; a second run without new files does nothing."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return step(stream).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of events by type in tumbling windows; rows later than `late` are dropped in a stream."""
    seen = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return seen.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def pending(work: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """Work that is not marked complete; units that failed before come again."""
    return work.join(status.where("complete").select(key), key, "left_anti")


def mark(results: DataFrame, key: str, error: str = "error") -> DataFrame:
    """A status row for each unit: complete unless one of its rows has an error."""
    return results.groupBy(key).agg((F.count(error) == 0).alias("complete"), F.count("*").alias("rows"), F.count(error).alias("errors"), F.current_timestamp().alias("at"))
