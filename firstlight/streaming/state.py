"""First launch per device and day kept in streaming state.

The store-backed upsert compares every batch with the day's stored keys; these
forms keep the keys in the state store instead, so a batch costs what its own
rows cost. State is grouped by the time of arrival: a row belongs to the
window of ``expire`` in which it came, whatever its event day. A wild device
clock moves nothing, and the whole set of a window is dropped at once when the
window is over by ``CLOCK_ROOM``. The driver's clock may step back by as much
without a row being late, as after a restart on another host. A device that
comes again in a later window is emitted again; readers settle the versions
(:func:`firstlight.streaming.upsert.current`). Sets that end a fixed time after
their day's first insert are in :mod:`firstlight.streaming.epochs`.

Each batch is reduced per device before it is shuffled.

``first_per_day_stream`` emits a device once per window and day, with the
earliest launch of the batch it first came in; ``earliest_updates`` also emits
it again when an earlier launch arrives. Both have output mode ``update``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstlight.operators.dedup import LAUNCH_ORDER
from firstlight.schemas import DAU_COLUMNS

# How far the clock of the driver may step back without a row being late.
CLOCK_ROOM = "1 hour"


def _by_arrival(records: DataFrame, expire: str, order: Column, room: str) -> DataFrame:
    """``dt, mid, first_at, b``: per window and device its first arrival and its least launch by ``order``."""
    payload = F.struct(*[c for c in DAU_COLUMNS if c not in ("dt", "mid")], "seen_at")
    stamped = records.withColumn("seen_at", F.current_timestamp()).withWatermark("seen_at", room)
    return stamped.groupBy(F.window("seen_at", expire), "dt", "mid").agg(
        F.min("seen_at").alias("first_at"), F.min_by(payload, order).alias("b")
    )


def _records(found: DataFrame) -> DataFrame:
    return found.select(*[F.col(c) if c in ("dt", "mid") else F.col(f"b.{c}").alias(c) for c in DAU_COLUMNS])


def first_per_day_stream(records: DataFrame, expire: str = "24 hours", room: str = CLOCK_ROOM) -> DataFrame:
    """First arrivals per ``(dt, mid)`` of a stream of activity records; the set lives ``expire`` long."""
    found = _by_arrival(records, expire, F.struct("seen_at", *LAUNCH_ORDER), room)
    return _records(found.filter(F.col("first_at") == F.current_timestamp()))


def earliest_updates(records: DataFrame, expire: str = "24 hours", room: str = CLOCK_ROOM) -> DataFrame:
    """Records that are the earliest of their device and day so far in their window.

    A group whose least launch carries the current batch's stamp was created
    or improved by this batch; every other touched group is left out.
    """
    found = _by_arrival(records, expire, F.struct(*LAUNCH_ORDER, "seen_at"), room)
    return _records(found.filter(F.col("b.seen_at") == F.current_timestamp()))
