"""Launches per hour as a stream, whatever order they come in.

The hours are tumbling windows of event time, but state does not follow event
time: a wild clock would end all windows at once, and a late launch would be
lost.  State is grouped by the window of ``expire`` in which a launch arrives,
and by its hour.  A group counts what came for one hour in one window of
arrival; it is emitted whenever it grew and dropped when its arrival window is
over.  Reading takes the newest count of each group and adds the groups of an
hour up, so nothing is late and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firstlight.functions.clock import with_dt_hr
from firstlight.schemas import LAUNCH_HOURS
from firstlight.sources import folders
from firstlight.sources.store import read_or_empty
from firstlight.streaming.state import CLOCK_ROOM

_GROUP = ["arrival", "dt", "hr"]
FOLD_EVERY = 50


def hourly_counts(logs: DataFrame, expire: str = "24 hours", tz: str = "UTC", room: str = CLOCK_ROOM) -> DataFrame:
    """``arrival, dt, hr, n``: grown groups of a stream of logs with ``ts``; output mode ``update``.

    Counts are added up in each task before they are shuffled, so an hour with
    most of the launches is one row per task.
    """
    stamped = with_dt_hr(logs.select("ts"), "ts", tz).withColumn("seen_at", F.current_timestamp())
    stamped = stamped.filter(F.col("dt").isNotNull()).withWatermark("seen_at", room)
    counted = stamped.groupBy(F.window("seen_at", expire).alias("came"), "dt", "hr").agg(F.count("*").alias("n"))
    return counted.select(F.col("came.start").alias("arrival"), "dt", "hr", "n")


def start_hourly_counts(
    logs: DataFrame,
    path: str,
    checkpoint: str,
    expire: str = "24 hours",
    tz: str = "UTC",
    trigger: str | None = "5 seconds",
    fold_every: int = FOLD_EVERY,
    grace: float = folders.GRACE,
) -> StreamingQuery:
    """Keep the counts in ``path``, one folder per batch; every ``fold_every`` batches they become one folder."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # One file after an exchange: coalescing would run the state of all partitions in one task.
        batch.repartition(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if (batch_id + 1) % fold_every == 0:
            fold_hourly(batch.sparkSession, path, batch_id, grace)

    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    writer = hourly_counts(logs, expire, tz).writeStream.outputMode("update").foreachBatch(run)
    return writer.option("checkpointLocation", checkpoint).trigger(**timing).start()


def _newest(rows: DataFrame) -> DataFrame:
    """A group only grows, so its greatest count is its newest."""
    return rows.groupBy(*_GROUP).agg(F.max("n").alias("n"))


def fold_hourly(spark: SparkSession, path: str, below: int, grace: float = folders.GRACE) -> None:
    """Fold the batches below a number; a group that stands twice for a while still counts once."""
    replaced = folders.sweep(spark, path, grace)
    there = folders.numbers(spark, path, "batch_id", committed=False)
    own = [n for n in there if n < below and f"batch_id={n}" not in replaced]
    if len(own) < 2:
        return
    number = min([0, *there]) - 1
    rows = read_or_empty(spark, LAUNCH_HOURS, path).filter(F.col("batch_id").isin(own))
    _newest(rows).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={number}")
    folders.note_held(spark, path, f"batch_id={number}", [f"batch_id={n}" for n in own])
    if not grace:
        folders.sweep(spark, path, grace)


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """``dt, hr, n``: launches per hour so far."""
    newest = _newest(read_or_empty(spark, LAUNCH_HOURS, path))
    return newest.groupBy("dt", "hr").agg(F.sum("n").alias("n"))
