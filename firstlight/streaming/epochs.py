"""Sets of seen devices that expire as a whole, a fixed time after their first insert.

A day's set begins with the first batch that brings a record of the day and
lives ``expire`` long from that batch's arrival, whatever comes in between.
The batch that comes after it begins the next set, and its devices count as
new once more.  The begin is one row per set; the keys stand beside it in
``seen/dt=<day>/epoch=<batch that began it>/batch_id=<n>``.

Arrival is the stamp of the batch, which Spark's checkpoint fixes: a retry has
the same one.  A clock that steps back cannot end a set early nor lose a row:
a set only ends when a batch comes ``expire`` or more after its begin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.operators.dedup import first_per_day, new_to_day
from firstlight.schemas import DAU_COLUMNS, EPOCHS, SEEN
from firstlight.sources import folders
from firstlight.sources.store import StorePaths, no_rows, read_or_empty


def read_epochs(spark: SparkSession, store: StorePaths) -> DataFrame:
    """``dt, started, epoch``: every set that ever began; ``epoch`` is the batch that began it."""
    return read_or_empty(spark, EPOCHS, store.epochs)


def open_epochs(spark: SparkSession, store: StorePaths, days: list[str], batch_id: int, arrived: Column, expire: str) -> DataFrame:
    """``dt, started, epoch`` of the set that each day's records of this batch belong to.

    A new set of this batch has ``epoch = batch_id``; it is not yet written.
    """
    own = spark.createDataFrame([(d,) for d in days], "dt string").withColumn("now", arrived)
    known = read_epochs(spark, store).filter(F.col("epoch") < batch_id)
    last = known.groupBy("dt").agg(F.max_by(F.struct("epoch", "started"), "epoch").alias("last"))
    ended = F.col("last").isNull() | (F.col("now") >= F.col("last.started") + F.expr(f"INTERVAL {expire}"))
    both = own.join(last, "dt", "left")
    return both.select(
        "dt",
        F.when(ended, F.col("now")).otherwise(F.col("last.started")).alias("started"),
        F.when(ended, F.lit(batch_id).cast("long")).otherwise(F.col("last.epoch")).alias("epoch"),
    )


def read_seen(spark: SparkSession, store: StorePaths, sets: list[tuple[str, int]]) -> DataFrame:
    """``mid, dt, epoch, batch_id`` of the named sets; only their folders are listed."""
    found = [f"{store.seen}/dt={d}/epoch={e}" for d, e in sets]
    found = [p for p in found if folders.exists(spark, p)]
    return spark.read.schema(SEEN).option("basePath", store.seen).parquet(*found) if found else no_rows(spark, SEEN)


def first_arrivals(
    records: DataFrame, days: list[str], batch_id: int, store: StorePaths, arrived: Column, expire: str = "24 hours"
) -> DataFrame:
    """The batch's records of devices that are not in their day's open set, and their entry into it.

    The caller stores the result under the same batch id; a retry gives the
    same rows, since only entries of smaller batch ids are looked at.
    """
    spark = records.sparkSession
    sets = [tuple(r) for r in open_epochs(spark, store, days, batch_id, arrived, expire).select("dt", "epoch", "started").collect()]  # one row per day
    begun = spark.createDataFrame([(d, s, e) for d, e, s in sets if e == batch_id], EPOCHS)
    of_day = spark.createDataFrame([(d, e) for d, e, _ in sets], "dt string, epoch long")
    seen = read_seen(spark, store, [(d, e) for d, e, _ in sets]).filter(F.col("batch_id") < batch_id)
    new = new_to_day(first_per_day(records), seen)
    entries = new.join(F.broadcast(of_day), "dt").select("mid", "dt", "epoch", F.lit(batch_id).cast("long").alias("batch_id"))
    (
        entries.hint("rebalance", "dt").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "epoch", "batch_id")
        .parquet(store.seen)
    )
    # The begin is written last and stays what it was in a retry; entries without it are not looked at.
    begun.coalesce(1).write.mode("overwrite").parquet(f"{store.epochs}/batch_id={batch_id}")
    own = read_seen(spark, store, [(d, e) for d, e, _ in sets]).filter(F.col("batch_id") == batch_id)
    return records.join(own.select("mid", "dt"), ["mid", "dt"], "left_semi").select(*DAU_COLUMNS)


def fold_seen(spark: SparkSession, store: StorePaths, day: str, below: int, grace: float = folders.GRACE) -> None:
    """Fold the open set of a day into one folder and remove the sets before it.

    A set is a union of keys, so one that is held twice for a while is the same set.
    """
    parent = f"{store.seen}/dt={day}"
    sets = folders.numbers(spark, parent, "epoch", committed=False)
    folders.remove(spark, [f"{parent}/epoch={n}" for n in sets[:-1]])
    if not sets:
        return
    parent = f"{parent}/epoch={sets[-1]}"
    replaced = folders.sweep(spark, parent, grace)
    there = folders.numbers(spark, parent, "batch_id", committed=False)
    own = [n for n in there if n < below and f"batch_id={n}" not in replaced]
    if len(own) < 2:
        return
    number = min([0, *there]) - 1
    keys = read_seen(spark, store, [(day, sets[-1])]).filter(F.col("batch_id").isin(own)).select("mid").distinct()
    keys.hint("rebalance").write.mode("overwrite").parquet(f"{parent}/batch_id={number}")
    folders.note_held(spark, parent, f"batch_id={number}", [f"batch_id={n}" for n in own])
