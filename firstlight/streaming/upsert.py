"""Keyed upsert of a micro-batch into the day-partitioned store, and compaction.

Parquet has no MERGE.  A batch writes new versions into its own partition
``dt=<day>/batch_id=<n>``; readers take the winning version per key.
Re-running a batch replaces its own partitions and compares only with smaller
batch ids, so a retry after any failure gives the same store.

A record that is earlier than its device's stored one moves the device to
another hour.  The batch therefore also writes what it changes in the hour
counts, -1 for the old hour and +1 for the new one (:mod:`firstlight.sources.sums`):
dashboards read these sums and no record.
"""

from __future__ import annotations

from typing import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firstlight.operators.dedup import DAY_DEVICE, LAUNCH_ORDER, first_per_day, new_to_day
from firstlight.schemas import DAU_COLUMNS, HOUR_SUMS, RUNS
from firstlight.sources import folders
from firstlight.sources.store import StorePaths, init_store, read_day, read_days, read_or_empty
from firstlight.sources.sums import read_sums, write_changes

HOUR = ["dt", "hr"]


def unseen(records: DataFrame, stored: DataFrame, keep: str) -> DataFrame:
    """The batch's records worth storing, with ``was_hr``, the hour that the device had until now.

    ``earliest``: a record is stored when it is new or comes before every
    stored version.  ``arrival``: only when its device is new to the day.
    """
    firsts = first_per_day(records)
    if keep == "arrival":
        return new_to_day(firsts, stored).withColumn("was_hr", F.lit(None).cast("string"))
    if keep != "earliest":
        raise ValueError("keep is 'earliest' or 'arrival'")
    order = F.struct(*LAUNCH_ORDER)
    best = stored.groupBy(*DAY_DEVICE).agg(F.min(F.struct(order.alias("at"), "hr")).alias("best"))
    joined = firsts.withColumn("own", order).join(best, list(DAY_DEVICE), "left")
    kept = joined.filter(F.col("best").isNull() | ~(F.col("best.at") <= F.col("own")))
    return kept.select(*DAU_COLUMNS, F.col("best.hr").alias("was_hr"))


def hour_changes(winners: DataFrame) -> DataFrame:
    """``dt, hr, n``: +1 for the hour of each stored record, -1 for the hour that its device leaves."""
    change = lambda hr, n: F.struct("dt", F.col(hr).alias("hr"), F.lit(n).cast("long").alias("n"))
    both = winners.select(F.inline(F.array(change("hr", 1), change("was_hr", -1))))
    return both.filter(F.col("hr").isNotNull())


def read_hours(spark: SparkSession, store: StorePaths) -> DataFrame:
    """``dt, hr, n``: devices by their first hour of the day, from the increments alone."""
    return read_sums(spark, store.hours, HOUR_SUMS, HOUR)


def write_versions(
    records: DataFrame, path: str, batch_id: int, layout: str = "rebalance", counts: tuple[Observation, dict[str, Column]] | None = None
) -> None:
    """Write one batch's versions, replacing what an earlier try of the batch wrote.

    ``rebalance`` joins small files and lets AQE split a day that holds most
    of the rows.  ``spread``: the output of a stateful stream is spread
    already, by device over all its tasks, and is written from there.
    ``ranged`` gives each file a range of devices of its own.  Within a file
    rows are sorted by device, with a Bloom filter, for point lookups.
    ``counts`` are aggregates over the records, taken while they are written.
    """
    versions = records.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if layout == "rebalance":
        versions = versions.hint("rebalance", "dt")
    elif layout == "ranged":
        versions = versions.repartitionByRange("dt", "mid")
    versions = versions.sortWithinPartitions("dt", "batch_id", "mid")
    if counts:
        # Above the shuffle: Spark drops what stands below one that turns out empty.
        versions = versions.observe(counts[0], *[c.alias(n) for n, c in counts[1].items()])
    (
        versions.select(*DAU_COLUMNS, "batch_id").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#mid", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("dt", "batch_id")
        .parquet(path)
    )


def upsert_by_key(
    records: DataFrame,
    batch_id: int,
    store: StorePaths,
    keep: str = "earliest",
    days: Iterable[str] | None = None,
    seen: DataFrame | None = None,
) -> dict[str, int]:
    """Add a batch of activity records to the store; the counts ``written``, ``added`` and ``days`` of what it wrote.

    ``days`` names the days of the records, where the caller knows them; only
    these are read back.  ``seen`` replaces the day's stored keys as what a
    record is compared with.  The counts are taken while the rows are written.
    """
    if days is None:
        days = [r["dt"] for r in records.select("dt").distinct().collect()]
    if seen is None:
        seen = read_days(records.sparkSession, store, days).filter(F.col("batch_id") < batch_id)
    winners = unseen(records, seen, keep).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        observed = Observation()
        counts = {
            "written": F.count(F.lit(1)),
            "added": F.count_if(F.col("was_hr").isNull()),
            "days": F.size(F.collect_set("dt")).cast("long"),
        }
        write_versions(winners, store.dau, batch_id, counts=(observed, counts))
        write_changes(hour_changes(winners), store.hours, batch_id, HOUR)
        return observed.get
    finally:
        winners.unpersist()


def batch_metrics(
    spark: SparkSession, store: StorePaths, batch_id: int, days: Iterable[str] | None = None
) -> DataFrame:
    """``dt, written``: records of a batch that are in the store, by day; an audit of what the batch counted."""
    own = read_days(spark, store, days).filter(F.col("batch_id") == batch_id)
    return own.groupBy("dt").agg(F.count("*").alias("written"))


def current(stored: DataFrame) -> DataFrame:
    """One row per device and day: the winning stored version."""
    return first_per_day(stored, order=(*LAUNCH_ORDER, "batch_id")).drop("batch_id")


def compact(spark: SparkSession, store: StorePaths, day: str, below: int | None = None, grace: float = folders.GRACE) -> None:
    """Fold the versions of a day into one partition, while the day stays readable.

    The folded rows are written as one more partition, which notes the
    partitions that it holds; a later fold removes these ``grace`` seconds
    afterwards, so a frame made before the fold can be read to its end.  Until
    then, and after a run that died, the day has surplus versions, which
    readers settle as always.  ``below`` folds only batches of smaller
    numbers; the one that writes the store passes the number of its next
    batch, others fold closed days.
    """
    parent = f"{store.dau}/dt={day}"
    replaced = folders.sweep(spark, parent, grace)
    there = [n for n in folders.numbers(spark, parent, "batch_id", committed=False) if f"batch_id={n}" not in replaced]
    own = [n for n in there if below is None or n < below]
    if len(own) < 2:
        return
    # Folded partitions count down from -1, so no fold replaces one that it reads.
    number = min([0, *folders.numbers(spark, parent, "batch_id", committed=False)]) - 1
    versions = read_day(spark, store, day).filter(F.col("batch_id").isin(own))
    write_versions(current(versions), store.dau, number, layout="ranged")
    folders.note_held(spark, parent, f"batch_id={number}", [f"batch_id={n}" for n in own])
    if not grace:
        folders.sweep(spark, parent, grace)


def batch_base(spark: SparkSession, store: StorePaths, checkpoint: str) -> int:
    """Number to add to a stream's batch ids, the same for every start of one checkpoint.

    A new checkpoint counts its batches from 0 again; its batches continue
    after the largest number in the store.
    """
    runs = read_or_empty(spark, RUNS, store.runs)
    known = runs.filter(F.col("checkpoint") == checkpoint).agg(F.min("batch_base").alias("b")).first()["b"]
    if known is not None:
        return known
    top = read_days(spark, store).agg(F.max("batch_id").alias("b")).first()["b"]
    # The store's folded partitions have negative numbers; counted batches go on after all that ever ran.
    counted = folders.numbers(spark, store.batches, "batch_id", committed=False)
    top = max([n for n in (top, *counted[-1:]) if n is not None], default=None)
    if top is None:
        init_store(spark, store)
    base = 0 if top is None else max(top, -1) + 1
    run = spark.range(1).select(F.lit(checkpoint).alias("checkpoint"), F.lit(base).cast("long").alias("batch_base"))
    run.coalesce(1).write.mode("append").parquet(store.runs)
    return base
