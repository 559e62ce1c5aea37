"""The day-partitioned store of activity records.

``<root>/dau/dt=<day>/batch_id=<n>`` holds the records one micro-batch wrote
for one day.  Reading a day lists that day's folder only, so its cost does not
grow with history.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstlight.schemas import DAU_STORE
from firstlight.sources.folders import exists, names


@dataclass(frozen=True)
class StorePaths:
    """Folders under one root."""

    root: str

    def _sub(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def dau(self) -> str:
        return self._sub("dau")

    @property
    def ledger(self) -> str:
        return self._sub("ledger")

    @property
    def quarantine(self) -> str:
        return self._sub("quarantine")

    @property
    def runs(self) -> str:
        return self._sub("runs")

    @property
    def first_seen(self) -> str:
        return self._sub("first_seen")

    @property
    def hours(self) -> str:
        return self._sub("hours")

    @property
    def batches(self) -> str:
        return self._sub("batches")

    @property
    def epochs(self) -> str:
        return self._sub("epochs")

    @property
    def seen(self) -> str:
        return self._sub("seen")

    @property
    def device_days(self) -> str:
        return self._sub("device_days")

    @property
    def new_devices(self) -> str:
        return self._sub("new_devices")


# A partition without rows: with it a read of days that have no folder yet
# still finds one.
NO_DAY = "none"


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame made on the JVM side."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def init_store(spark: SparkSession, store: StorePaths) -> None:
    """Make the empty partition of a new store."""
    empty = no_rows(spark, DAU_STORE).drop("dt", "batch_id").coalesce(1)
    empty.write.mode("overwrite").parquet(f"{store.dau}/dt={NO_DAY}/batch_id=-1")


def read_or_empty(spark: SparkSession, schema: StructType, base: str, fmt: str = "parquet") -> DataFrame:
    """A folder of files, or no rows where nothing was written yet."""
    if not exists(spark, base):
        return no_rows(spark, schema)
    return spark.read.schema(schema).option("basePath", base).format(fmt).load(base).select(*schema.fieldNames())


def read_days(spark: SparkSession, store: StorePaths, days: Iterable[str] | None = None) -> DataFrame:
    """All stored versions of the given days, or of every day.

    Of the days only folders that exist are named to Spark; no other day's
    folder is listed.
    """
    if days is None:
        return read_or_empty(spark, DAU_STORE, store.dau)
    there = set(names(spark, store.dau))
    found = [f"{store.dau}/dt={d}" for d in [NO_DAY, *sorted(set(days))] if f"dt={d}" in there]
    if not found:
        return no_rows(spark, DAU_STORE)
    return spark.read.schema(DAU_STORE).option("basePath", store.dau).parquet(*found)


def read_day(spark: SparkSession, store: StorePaths, day: str) -> DataFrame:
    return read_days(spark, store, [day])


def get_device(spark: SparkSession, store: StorePaths, day: str, mid: str) -> DataFrame:
    """All stored versions of one device on one day.

    Files are sorted by device and carry a Bloom filter of their devices, so
    of the day's files only the row groups, and in them the pages, that can
    hold the device are read.
    """
    return get_by_id(read_day(spark, store, day), "mid", mid)


def get_by_id(df: DataFrame, key: str, value: Any) -> DataFrame:
    """Point lookup; the equality reaches the Parquet scan."""
    return df.filter(F.col(key) == F.lit(value))
