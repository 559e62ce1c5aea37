"""Offset ranges of a batch and their read-back."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.schemas import OFFSET_LEDGER
from firstlight.sources.logs import starting_offsets
from firstlight.sources.store import StorePaths, read_or_empty


def offset_ledger(batch: DataFrame, batch_id: int) -> DataFrame:
    """First and next offset of each topic partition in the batch."""
    return (
        batch.filter(F.col("offset").isNotNull())
        .groupBy("topic", "partition")
        .agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
        .select(
            F.lit(batch_id).cast("long").alias("batch_id"), "topic", "partition", "from_offset", "until_offset"
        )
    )


def read_ledger(spark: SparkSession, store: StorePaths) -> DataFrame:
    return read_or_empty(spark, OFFSET_LEDGER, store.ledger)


def next_offsets(ledger: DataFrame, topic: str) -> DataFrame:
    """``partition, offset``: where the next read of a topic starts."""
    return (
        ledger.filter(F.col("topic") == topic).groupBy("partition").agg(F.max("until_offset").alias("offset"))
    )


def resolve_start(ledger: DataFrame, topic: str, partitions: Iterable[int] | None = None) -> str:
    """The ``startingOffsets`` option: the ledger's next offsets, else latest.

    Collects one row per partition of the topic, never more.
    """
    rows = next_offsets(ledger, topic).collect()
    return starting_offsets(topic, {r["partition"]: r["offset"] for r in rows}, partitions)
