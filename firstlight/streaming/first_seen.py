"""Each device's first day: a table built day by day, and one kept up to date per batch.

``<root>/first_seen/dt=<day>`` holds the devices first seen on that day, so
the day's new devices are a count of one partition.

``<root>/device_days`` has the first days bucketed by device.  A batch merges
its devices into it by their least day, so late records correct themselves,
and adds what it changes in the counts of new devices as increments.
"""

from __future__ import annotations

import hashlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firstlight.operators.dedup import new_to_day
from firstlight.operators.ingest import parse_logs, to_dau_info, usable
from firstlight.schemas import DAY_SUMS, FIRST_SEEN
from firstlight.sources import folders
from firstlight.sources.store import StorePaths, read_day, read_days, read_or_empty
from firstlight.sources.sums import fold_sums, read_sums, write_changes


def read_first_seen(spark: SparkSession, store: StorePaths) -> DataFrame:
    return read_or_empty(spark, FIRST_SEEN, store.first_seen)


def has_first_seen(spark: SparkSession, store: StorePaths, day: str) -> bool:
    """Whether the day's partition was built; one without rows counts."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store.first_seen}/dt={day}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def rebuild_first_seen(spark: SparkSession, store: StorePaths) -> None:
    """Write all days' partitions from the store in one pass; late records are in their place then."""
    first = read_days(spark, store).groupBy("mid").agg(F.min("dt").alias("dt"))
    first.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("dt").parquet(store.first_seen)


def update_first_seen(spark: SparkSession, store: StorePaths, day: str) -> None:
    """(Re)build one day's partition from the store and the days before.

    Days are built in order.  After late records for a day, run it again for
    that day and the ones after.
    """
    earlier = read_first_seen(spark, store).filter(F.col("dt") < day)
    today = read_day(spark, store, day).select("mid").distinct()
    new = new_to_day(today, earlier, keys=["mid"])
    new.hint("rebalance").write.mode("overwrite").parquet(f"{store.first_seen}/dt={day}")


# --- kept up to date per batch


BUCKETS = 64


def _location(store: StorePaths, buckets: int, generation: int) -> str:
    return f"{store.device_days}/buckets-{buckets}/generation={generation}"


def device_days(spark: SparkSession, store: StorePaths, buckets: int = BUCKETS, generation: int | None = None) -> str:
    """Name of the catalog table of ``mid, dt, batch_id``, bucketed by device, over the store's newest generation.

    Bucketing is a property of a catalog table; the files are the store's own,
    and a session that does not know the table yet takes them as they are.
    """
    if generation is None:
        generation = max(folders.numbers(spark, f"{store.device_days}/buckets-{buckets}", "generation"), default=0)
    location = _location(store, buckets, generation)
    name = "device_days_" + hashlib.md5(location.encode()).hexdigest()
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (mid STRING, dt STRING, batch_id BIGINT) USING parquet "
        f"CLUSTERED BY (mid) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    spark.catalog.refreshTable(name)
    return name


def _known(rows: DataFrame) -> DataFrame:
    """``mid, was``: each device's first day; bucketed rows are not shuffled for it."""
    return rows.groupBy("mid").agg(F.min("dt").alias("was"))


def earlier_days(records: DataFrame, history: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``mid, dt, was`` of devices that are new, or seen on an earlier day than all of ``history``.

    The batch, one row per device, is shuffled into the buckets of the
    history; the history stays where it is.
    """
    own = records.groupBy("mid").agg(F.min("dt").alias("dt")).repartition(buckets, "mid")
    both = own.join(_known(history).hint("merge"), "mid", "left")
    return both.filter(F.col("was").isNull() | (F.col("dt") < F.col("was")))


def merge_first_seen(records: DataFrame, batch_id: int, store: StorePaths, buckets: int = BUCKETS) -> None:
    """Merge the devices and days of a batch into the first days, and correct the counts of new devices.

    A record of an earlier day than the device's first takes the device from
    the later day to its own: -1 there, +1 here.  A retry compares with
    smaller batch ids only, so it writes the same; a row that is there twice
    does not change a least day.
    """
    spark = records.sparkSession
    name = device_days(spark, store, buckets)
    history = spark.table(name).filter(F.col("batch_id") < batch_id)
    changed = earlier_days(records, history, buckets).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        change = lambda day, n: F.struct(F.col(day).alias("dt"), F.lit(n).cast("long").alias("n"))
        changes = changed.select(F.inline(F.array(change("dt", 1), change("was", -1)))).filter(F.col("dt").isNotNull())
        write_changes(changes, store.new_devices, batch_id, ["dt"])
        changed.select("mid", "dt", F.lit(batch_id).cast("long").alias("batch_id")).write.insertInto(name)
    finally:
        changed.unpersist()


def read_new_devices(spark: SparkSession, store: StorePaths) -> DataFrame:
    """``dt, n``: devices by the day they were first seen, from the increments alone."""
    return read_sums(spark, store.new_devices, DAY_SUMS, ["dt"])


def fold_first_seen(spark: SparkSession, store: StorePaths, below: int, buckets: int = BUCKETS, grace: float = folders.GRACE) -> None:
    """Rewrite the first days as one row per device, in the same buckets and without a shuffle, as the next generation.

    To be called between batches, with the number of the next one.
    Generations before the newest go when that is ``grace`` seconds old.
    """
    parent = f"{store.device_days}/buckets-{buckets}"
    done = folders.numbers(spark, parent, "generation")
    if not done:
        return
    newest = done[-1]
    if folders.age(spark, f"{parent}/generation={newest}/_SUCCESS") >= grace:
        folders.remove(spark, [f"{parent}/generation={n}" for n in done[:-1]])
    old = device_days(spark, store, buckets, newest)
    folders.remove(spark, [_location(store, buckets, newest + 1)])  # what a fold that died has left
    new = device_days(spark, store, buckets, newest + 1)
    least = F.min(F.struct("dt", "batch_id")).alias("least")
    rows = spark.table(old).filter(F.col("batch_id") < below).groupBy("mid").agg(least)
    rows.select("mid", "least.dt", "least.batch_id").write.insertInto(new)
    fold_sums(spark, store.new_devices, DAY_SUMS, ["dt"], below - 1, grace)


def start_first_seen(
    logs: DataFrame,
    root: str,
    checkpoint: str,
    tz: str = "UTC",
    trigger: str | None = "1 minute",
    buckets: int = BUCKETS,
    fold_every: int = 50,
    grace: float = folders.GRACE,
) -> StreamingQuery:
    """Keep first days and counts of new devices up to date from a stream of raw logs.

    A batch reads the device column of the history once, so its trigger may be
    longer than that of the activity records.
    """
    store = StorePaths(root)

    def run(batch: DataFrame, batch_id: int) -> None:
        merge_first_seen(to_dau_info(usable(parse_logs(batch.select("value"))), tz), batch_id, store, buckets)
        if (batch_id + 1) % fold_every == 0:
            fold_first_seen(batch.sparkSession, store, batch_id + 1, buckets, grace)

    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    writer = logs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**timing).start()
