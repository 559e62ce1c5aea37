"""Streaming sinks of the ingest job: raw landing, topic routing, quarantine.

Bodies are written as text, one to a line: a line break in a body is white
space between its JSON parts and becomes a blank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firstlight.operators.ingest import EVENT_TOPIC, START_TOPIC, one_line, parse_logs, quarantine, route_logs
from firstlight.schemas import INGESTED
from firstlight.sources.logs import kafka_sink_options
from firstlight.sources.store import read_or_empty

RAW, TOPICS, REJECTED = "raw", "topics", "rejected"


def _start(writer, checkpoint: str, trigger: str | None) -> StreamingQuery:
    timing = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.option("checkpointLocation", checkpoint).trigger(**timing).start()


def _dated(logs: DataFrame) -> DataFrame:
    """With an ``ingest_date``: in a stream the day of the micro-batch's stamp, which a retry keeps."""
    return logs if "ingest_date" in logs.columns else logs.withColumn("ingest_date", F.current_date().cast("string"))


def outputs(logs: DataFrame) -> DataFrame:
    """``value, sink, part``: what each body is written to, from one parse.

    Every body goes to the landing of its ingest date.  A JSON body goes to
    the topic of launches or of other logs.  A body that no activity record
    can be made of goes to the quarantine of its reason.
    """
    parsed = parse_logs(_dated(logs).select("value", "ingest_date", one_line("value").alias("line")))
    out = lambda sink, part: F.struct(F.lit(sink).alias("sink"), part.alias("part"))
    topic = F.when(F.col("reason").eqNullSafe("bad_json"), None).when(F.col("has_start"), START_TOPIC).otherwise(EVENT_TOPIC)
    targets = F.array(out(RAW, F.col("ingest_date")), out(TOPICS, topic), out(REJECTED, F.col("reason")))
    spread = parsed.select(F.col("line").alias("value"), F.inline(targets))
    return spread.filter(F.col("part").isNotNull() & F.col("value").isNotNull())


def ingest_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Write a batch to the three sinks in one job, straight from the tasks that read it.

    The batch's folders replace those of an earlier try.  A task writes one
    file for each ingest date, topic and reason that it meets, of which there
    are few.
    """
    rows = outputs(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sink", "part", "batch_id")
        .text(root)
    )


def read_ingested(spark: SparkSession, root: str, sink: str | None = None) -> DataFrame:
    """``value, sink, part, batch_id`` of one sink or of all."""
    rows = read_or_empty(spark, INGESTED, root, fmt="text")
    return rows if sink is None else rows.filter(F.col("sink") == sink)


def start_ingest(logs: DataFrame, root: str, checkpoint: str, trigger: str | None = "5 seconds") -> StreamingQuery:
    """Landing, routing and quarantine as one stream: each body is read and parsed once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, root)

    return _start(_dated(logs).writeStream.foreachBatch(run), checkpoint, trigger)


def land_raw_stream(
    logs: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds"
) -> StreamingQuery:
    """Every body, text only, into one folder per ingest date.

    The file sink's own commit log makes each batch appear once.  Without an
    ``ingest_date`` column the current date is used.
    """
    bodies = _dated(logs).select(one_line("value").alias("value"), "ingest_date")
    writer = bodies.writeStream.format("text").partitionBy("ingest_date").option("path", path)
    return _start(writer, checkpoint, trigger)


def quarantine_stream(
    logs: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds"
) -> StreamingQuery:
    """``value, reason`` of unusable bodies."""
    rejected = quarantine(parse_logs(logs.select("value")))
    return _start(rejected.writeStream.format("parquet").option("path", path), checkpoint, trigger)


def _routed(logs: DataFrame, value: Column) -> DataFrame:
    return route_logs(logs).filter(F.col("topic").isNotNull()).select(value.alias("value"), "topic")


def route_stream_to_files(
    logs: DataFrame, path: str, checkpoint: str, trigger: str | None = "5 seconds"
) -> StreamingQuery:
    """Routed bodies into one text folder per topic."""
    writer = _routed(logs, one_line("value")).writeStream.format("text").partitionBy("topic").option("path", path)
    return _start(writer, checkpoint, trigger)


def route_stream_to_kafka(
    logs: DataFrame, servers: str, checkpoint: str, trigger: str | None = "5 seconds"
) -> StreamingQuery:
    """Routed bodies to the Kafka topic each row names."""
    writer = _routed(logs, F.col("value")).writeStream.format("kafka").options(**kafka_sink_options(servers))
    return _start(writer, checkpoint, trigger)
