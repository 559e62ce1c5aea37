"""Parsing, quarantine, routing and landing of raw logs.  All of it works on tables and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firstlight.functions.clock import TS_MAX, TS_MIN, minute_text, with_dt_hr
from firstlight.schemas import DAU_COLUMNS, LOG_SCHEMA, ROUTE_SCHEMA

START_TOPIC = "start_log"
EVENT_TOPIC = "event_log"

_JSON = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _parse_once(value: Column, schema: StructType, name: str) -> list[Column]:
    """The parsed body as a column that a filter cannot be pushed below.

    Catalyst would otherwise copy ``from_json`` into the filter, once per use,
    and parse each body several times.  A generator of exactly one row stops it.
    """
    return [F.explode(F.array(F.from_json(value, schema, _JSON))).alias(name)]


def parse_logs(logs: DataFrame, value: str = "value") -> DataFrame:
    """Flatten the JSON body into ``mid, uid, ar, ch, vc, ts, has_start`` plus ``reason``.

    ``reason`` is NULL for a usable row, else why it is not: ``bad_json``,
    ``no_ts`` (absent, not a number, or outside the years 1-9999) or
    ``no_mid``.  The body itself is kept for unusable rows only.
    """
    passed = [c for c in logs.columns if c != value]
    fields = logs.select(value, *passed, *_parse_once(F.col(value), LOG_SCHEMA, "_log"))
    bad_json = F.col("_log").isNull() | F.col("_log._corrupt").isNotNull()
    ts = F.col("_log.ts").try_cast("bigint")
    usable_ts = F.coalesce(ts.between(TS_MIN, TS_MAX), F.lit(False))
    reason = (
        F.when(bad_json, "bad_json")
        .when(~usable_ts, "no_ts")
        .when(F.col("_log.common.mid").isNull(), "no_mid")
    )
    return fields.select(
        *passed,
        *[F.col(f"_log.common.{c}").alias(c) for c in ("mid", "uid", "ar", "ch", "vc")],
        ts.alias("ts"),
        F.col("_log.start").isNotNull().alias("has_start"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.col(value)).alias("body"),
    )


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason", "body")


def quarantine(parsed: DataFrame) -> DataFrame:
    """``value, reason`` of the unusable rows."""
    return parsed.filter(F.col("reason").isNotNull()).select(F.col("body").alias("value"), "reason")


def to_dau_info(logs: DataFrame, tz: str = "UTC", minute: str = "zero") -> DataFrame:
    """The nine-column activity record.  ``minute``: ``zero`` writes "00", ``event`` the real minute."""
    if minute not in ("zero", "event"):
        raise ValueError("minute is 'zero' or 'event'")
    mi = F.lit("00") if minute == "zero" else minute_text("ts", tz)
    if not {"dt", "hr"} <= set(logs.columns):
        logs = with_dt_hr(logs, "ts", tz)
    return logs.withColumn("mi", mi).select(*DAU_COLUMNS)


def route_logs(
    logs: DataFrame, value: str = "value", start_topic: str = START_TOPIC, event_topic: str = EVENT_TOPIC
) -> DataFrame:
    """``value, topic``: launch logs to one topic, all others to the other.

    A body that is not a JSON object has no topic (NULL): it belongs in the
    quarantine, not in a topic.
    """
    topic = (
        F.when(F.col("_p").isNull() | F.col("_p._corrupt").isNotNull(), F.lit(None))
        .when(F.col("_p.start").isNotNull(), F.lit(start_topic))
        .otherwise(F.lit(event_topic))
    )
    probed = logs.select(F.col(value).alias("value"), *_parse_once(F.col(value), ROUTE_SCHEMA, "_p"))
    return probed.select("value", topic.alias("topic"))


def one_line(value: str) -> Column:
    """A body on one line; a line break in JSON is white space between its parts."""
    return F.regexp_replace(F.col(value), r"[\r\n]+", " ").alias("value")


def write_routed(routed: DataFrame, path: str) -> None:
    """Append the routed bodies to one text folder per topic, straight from the tasks that read them.

    There are two topics, so a task writes two files at most.
    """
    known = routed.filter(F.col("topic").isNotNull()).select(one_line("value"), "topic")
    known.write.mode("append").partitionBy("topic").text(path)


def land_raw(logs: DataFrame, path: str, ingest_date: str = "ingest_date", value: str = "value") -> None:
    """Append every body to one text folder per ingest date, straight from the tasks that read them.

    Logs arrive day by day, so a task has a day or two; lay out a backfill of
    mixed days by day before.
    """
    logs.select(one_line(value), ingest_date).write.mode("append").partitionBy(ingest_date).text(path)
