"""Times of micro-batches, kept as a table by a listener.

A batch's duration is known when it is over, so the batch cannot store it
itself.  The listener gets every finished trigger's progress from Spark and
adds one row per batch to a folder; a batch that ran again has a second row.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from firstlight.schemas import BATCH_TIMES
from firstlight.sources.store import read_or_empty


class BatchTimes(StreamingQueryListener):
    """Adds ``query, started, batch_id, rows, trigger_ms, write_ms`` of every batch with rows to ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        took = p.durationMs
        row = (str(p.id), started, p.batchId, p.numInputRows, took.get("triggerExecution"), took.get("addBatch"))
        self.spark.createDataFrame([row], BATCH_TIMES).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_batch_times(spark: SparkSession, path: str, query: str | None = None) -> DataFrame:
    """The rows of all queries that the listener saw, or of one."""
    rows = read_or_empty(spark, BATCH_TIMES, path)
    return rows if query is None else rows.filter(F.col("query") == query)


def late_batches(times: DataFrame, interval_ms: int) -> DataFrame:
    """The batches that took longer than their trigger's interval."""
    return times.filter(F.col("trigger_ms") > interval_ms)
