"""The launch pipeline: raw log stream to the store, with quarantine and ledger.

Delivery is exactly once: Spark's checkpoint fixes the rows of every batch,
every write of a batch replaces what an earlier try left, and offsets are
committed (checkpoint and ledger) after the records.
"""

from __future__ import annotations

import json
from typing import Any, Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firstlight.functions.clock import with_dt_hr
from firstlight.operators.ingest import parse_logs, quarantine, to_dau_info, usable
from firstlight.operators.ledger import offset_ledger
from firstlight.schemas import BATCHES, HOUR_SUMS
from firstlight.sources import folders
from firstlight.sources.store import StorePaths, read_or_empty
from firstlight.sources.sums import fold_sums
from firstlight.streaming.epochs import first_arrivals, fold_seen
from firstlight.streaming.state import earliest_updates
from firstlight.streaming.upsert import HOUR, batch_base, compact, upsert_by_key, write_versions

Metrics = Callable[[dict[str, Any]], None]

# Batches after which the pipeline folds the days that it wrote since.
FOLD_EVERY = 50

# The batch's arrival: Spark's stamp of the micro-batch, the same in a retry.
ARRIVED = "arrived_at"


def process_batch(
    batch: DataFrame,
    batch_id: int,
    store: StorePaths,
    keep: str = "earliest",
    tz: str = "UTC",
    minute: str = "zero",
    on_metrics: Metrics | None = None,
    expire: str | None = None,
) -> None:
    """One micro-batch of raw logs.  Also usable on its own for a batch import.

    ``expire``, with ``keep="arrival"``, ends a day's set of seen devices that
    long after its first insert; the arrival is the column ``arrived_at`` of
    the batch, one value, or now.  What the batch read and wrote is counted
    while it is written and kept as one row of the table of batches.
    """
    if expire and keep != "arrival":
        raise ValueError("only arrivals expire")
    parsed = with_dt_hr(parse_logs(batch), "ts", tz)
    # Read up to four times below; kept without the bodies of usable rows.
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        arrived = F.max(ARRIVED) if ARRIVED in batch.columns else F.current_timestamp()
        counts = parsed.agg(
            F.count("*").alias("logs"),
            F.count("reason").alias("rejected"),
            F.count("offset").alias("offsets"),
            F.collect_set(F.when(F.col("reason").isNull(), F.col("dt"))).alias("days"),
            arrived.alias("arrived"),
        ).first()
        if counts["rejected"]:
            rejected = quarantine(parsed).write.mode("overwrite")
            rejected.parquet(f"{store.quarantine}/batch_id={batch_id}")
        wrote = {"written": 0, "added": 0, "days": 0}
        if counts["days"]:
            records = to_dau_info(usable(parsed), tz, minute)
            seen = None
            if expire:
                records = first_arrivals(records, counts["days"], batch_id, store, F.lit(counts["arrived"]), expire)
                seen = records.limit(0)
            wrote = upsert_by_key(records, batch_id, store, keep, counts["days"], seen)
        if counts["offsets"]:
            ledger = offset_ledger(parsed, batch_id).drop("batch_id").coalesce(1)
            ledger.write.mode("overwrite").parquet(f"{store.ledger}/batch_id={batch_id}")
        figures = {"logs": counts["logs"], "rejected": counts["rejected"], **wrote}
        folders.write_text(batch.sparkSession, f"{store.batches}/batch_id={batch_id}/figures.json", json.dumps(figures))
        if on_metrics:
            on_metrics({"batch_id": batch_id, "days": wrote["days"], "written": wrote["written"]})
    finally:
        parsed.unpersist()


def read_batches(spark: SparkSession, store: StorePaths) -> DataFrame:
    """``batch_id, logs, rejected, written, added, days`` of every batch, counted while it was written."""
    return read_or_empty(spark, BATCHES, store.batches, fmt="json")


def fold_recent(spark: SparkSession, store: StorePaths, batch_id: int, every: int, grace: float = folders.GRACE) -> None:
    """After each ``every``-th batch, fold the days that the last ``every`` batches wrote.

    Earlier batches are committed by then. A retry of the current batch writes
    its own partitions again, with the same rows, so the fold may hold them.
    """
    if (batch_id + 1) % every:
        return
    recent = set(range(batch_id - every + 1, batch_id + 1))
    for name in folders.names(spark, store.dau):
        day = name.removeprefix("dt=")
        if recent & set(folders.numbers(spark, f"{store.dau}/{name}", "batch_id", committed=False)):
            compact(spark, store, day, below=batch_id, grace=grace)
            fold_seen(spark, store, day, below=batch_id, grace=grace)
    fold_sums(spark, store.hours, HOUR_SUMS, HOUR, batch_id - 1, grace)


def start_pipeline(
    logs: DataFrame,
    root: str,
    checkpoint: str,
    keep: str = "earliest",
    tz: str = "UTC",
    minute: str = "zero",
    trigger: str | None = "5 seconds",
    on_metrics: Metrics | None = None,
    fold_every: int = FOLD_EVERY,
    expire: str | None = None,
    grace: float = folders.GRACE,
) -> StreamingQuery:
    """Start the pipeline.  ``trigger=None`` drains what is there and stops.

    After every ``fold_every`` batches the days written since the last fold
    are compacted, so an open day's folders stay few; what a fold replaced is
    kept ``grace`` seconds for readers.  ``expire`` as in :func:`process_batch`.

    The caller awaits the query: ``start_pipeline(...).awaitTermination()``.
    """
    store = StorePaths(root)
    base = batch_base(logs.sparkSession, store, checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, base + batch_id, store, keep, tz, minute, on_metrics, expire)
        fold_recent(batch.sparkSession, store, base + batch_id, fold_every, grace)

    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    stamped = logs.withColumn(ARRIVED, F.current_timestamp())
    writer = stamped.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**timing).start()


def start_state_pipeline(
    logs: DataFrame,
    root: str,
    checkpoint: str,
    expire: str = "24 hours",
    tz: str = "UTC",
    minute: str = "zero",
    trigger: str | None = "5 seconds",
    fold_every: int = FOLD_EVERY,
    grace: float = folders.GRACE,
) -> StreamingQuery:
    """As :func:`start_pipeline` with ``keep="earliest"``, with the keys in streaming state.

    A batch costs what its own rows cost, however many devices the day already
    has: the choice for short triggers.  State lives ``expire`` long by
    arrival; no launch is dropped, however late it comes.  Unusable logs are
    skipped here; a second query over the same source quarantines them.
    """
    store = StorePaths(root)
    base = batch_base(logs.sparkSession, store, checkpoint)
    records = to_dau_info(usable(parse_logs(logs.select("value"))), tz, minute)

    def run(batch: DataFrame, batch_id: int) -> None:
        write_versions(batch, store.dau, base + batch_id, layout="spread")
        fold_recent(batch.sparkSession, store, base + batch_id, fold_every, grace)

    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    writer = earliest_updates(records, expire).writeStream.outputMode("update").foreachBatch(run)
    return writer.option("checkpointLocation", checkpoint).trigger(**timing).start()
