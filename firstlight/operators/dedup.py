"""First, last and unseen rows per key."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_DEVICE = ("dt", "mid")

# Earliest launch wins; equal stamps are settled by the remaining fields, so
# the winner does not depend on arrival order.
LAUNCH_ORDER = ("ts", "uid", "ch", "vc", "ar")


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key.

    Spark keeps one row per key and task before the shuffle
    (WindowGroupLimit), so a key holding a third of the rows sends one row per
    map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_per_day(
    df: DataFrame, keys: Sequence[str] = DAY_DEVICE, order: Sequence[str] = LAUNCH_ORDER
) -> DataFrame:
    """Each device's first launch of the day."""
    return _first(df, keys, [F.col(c).asc_nulls_first() for c in order])


def latest_by_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Last write per key; ``version`` columns must settle ties."""
    return _first(df, keys, [F.col(c).desc_nulls_last() for c in version])


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"n.{k}") == F.col(f"s.{k}") for k in keys])


def new_to_day(batch: DataFrame, seen: DataFrame, keys: Sequence[str] = DAY_DEVICE) -> DataFrame:
    """Rows of the batch whose key was not seen yet: first arrival wins.

    Seen keys are made distinct first: a key seen very often then reaches the
    join as one row, and the join uses the same shuffle.
    """
    seen = seen.select(*keys).distinct()
    return batch.alias("n").join(seen.alias("s"), _same_key(keys), "left_anti")


def earlier_than_seen(
    batch: DataFrame,
    seen: DataFrame,
    keys: Sequence[str] = DAY_DEVICE,
    order: Sequence[str] = LAUNCH_ORDER,
) -> DataFrame:
    """Rows of the batch that come before every seen row of their key, new keys included.

    ``seen`` may hold several versions of a key, one per batch at most; it is
    not aggregated first.
    """
    before = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    not_later = before("s") <= before("n")
    seen = seen.select(*dict.fromkeys([*keys, *order]))
    return batch.alias("n").join(seen.alias("s"), _same_key(keys) & not_later, "left_anti")
