"""Runs that can be taken up again, what a stream has done so far, and searches of which only the latest counts."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

Stage = tuple[str, Callable[[DataFrame], DataFrame]]


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a table was written to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def run_stages(spark: SparkSession, first: DataFrame, stages: Sequence[Stage], folder: str, told: Callable[[str, str], Any] = lambda name, state: None) -> DataFrame:
    """Each stage reads the table of the one before it and writes its own below the folder.

    A stage whose table is complete is not run again unless one before it was; a broken one starts over. `told` hears 'kept', 'started' and 'done'.
    """
    df, fresh = first, False
    for name, step in stages:
        at = f"{folder.rstrip('/')}/{name}"
        if fresh or not finished(spark, at):
            told(name, "started")
            step(df).write.mode("overwrite").parquet(at)
            told(name, "done")
            fresh = True
        else:
            told(name, "kept")
        df = spark.read.parquet(at)
    return df


class Progress(StreamingQueryListener):
    """Counts batches and rows of the streams of a session; `told` hears each batch as a dict."""

    def __init__(self, told: Callable[[dict], Any] = lambda batch: None) -> None:
        self.batches, self.rows, self.failed = 0, 0, []
        self.told = told

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        self.batches += 1
        self.rows += p.numInputRows
        self.told({"name": p.name, "batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond})

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        if event.exception:
            self.failed.append(event.exception)


class LatestSearch:
    """Searches as a user types: a new one interrupts the one that runs, and what an older one still finds is thrown away (None)."""

    def __init__(self, spark: SparkSession, search: Callable[[str], DataFrame], most: int = 500) -> None:
        self.spark, self.search, self.most = spark, search, most
        self._lock, self._newest = threading.Lock(), 0

    def __call__(self, phrase: str) -> list[Row] | None:
        with self._lock:
            self._newest += 1
            mine = self._newest
        self.spark.interruptTag(self._tag(mine - 1))
        self.spark.addTag(self._tag(mine))
        try:
            rows = self.search(phrase).limit(self.most).collect()
        except AnalysisException:
            raise
        except Exception:
            if mine == self._newest:
                raise
            return None  # interrupted by a newer search
        finally:
            self.spark.removeTag(self._tag(mine))
        return rows if mine == self._newest else None

    def _tag(self, number: int) -> str:
        return f"search-{id(self)}-{number}"
