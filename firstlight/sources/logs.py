"""Log sources.

A log source yields ``value, topic, partition, offset``, whatever the
transport.  The Kafka connector is not part of the PySpark distribution; it
has to be on the session's class path (``spark.jars.packages``).
"""

from __future__ import annotations

import json
from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.schemas import RAW_LOG

# What Spark's Kafka source calls the first offset there is.
EARLIEST = -2


def starting_offsets(topic: str, offsets: Mapping[int, int] | None, partitions: Iterable[int] | None = None) -> str:
    """Start position: the given next offset of each partition, else latest.

    The source wants every partition of the topic named. ``partitions`` lists
    them; those without an offset, new ones for instance, are read from their
    beginning. Only the first run of a query looks at this; later runs resume
    from their checkpoint.
    """
    if not offsets:
        return "latest"
    known = {p: EARLIEST for p in partitions or ()} | {p: int(o) for p, o in offsets.items()}
    return json.dumps({topic: {str(p): o for p, o in sorted(known.items())}})


def kafka_source_options(
    servers: str,
    topic: str,
    group: str | None = None,
    offsets: Mapping[int, int] | str | None = None,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source, a new dictionary on every call.

    Spark tracks offsets in the checkpoint and never commits to the group, and
    by default gives every query a group of its own; two queries that share a
    named group may each read a part.  ``min_partitions`` splits large
    topic partitions over more tasks.  ``offsets`` may be a ready
    ``startingOffsets`` text.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets if isinstance(offsets, str) else starting_offsets(topic, offsets),
        "failOnDataLoss": "true",
    }
    if group:
        options["kafka.group.id"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_sink_options(servers: str) -> dict[str, str]:
    """Options of the Kafka sink; the target topic comes from the ``topic`` column."""
    return {"kafka.bootstrap.servers": servers}


def read_kafka_log_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, **options)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_file_log_stream(
    spark: SparkSession,
    path: str,
    topic: str = "start_log",
    fmt: str = "text",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Stream of log files: text with one JSON body per line, or Parquet with the source columns.

    ``max_files`` or ``max_bytes`` bounds a batch; the size is the better
    bound, since it holds whatever the files' sizes.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    if fmt == "text":
        # Files carry no partition or offset of their own.
        return reader.text(path).select(
            "value",
            F.lit(topic).alias("topic"),
            F.lit(None).cast("int").alias("partition"),
            F.lit(None).cast("long").alias("offset"),
        )
    return reader.schema(RAW_LOG).format(fmt).load(path)
