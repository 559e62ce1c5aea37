"""Jobs for spark-submit: ``spark-submit --py-files firstlight.zip run.py <job> ...``, or
``python -m firstlight.jobs <job> ...``.
"""

from __future__ import annotations

import argparse
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from firstlight.functions.clock import previous_day
from firstlight.functions.labels import DEFAULT_SALE_DATE, PAGE_SIZES
from firstlight.operators.ingest import parse_logs, usable
from firstlight.operators.ledger import read_ledger, resolve_start
from firstlight.operators.metrics import compare_hours, kpi_of_sums
from firstlight.operators.sale import build_sale_detail, write_sale_detail
from firstlight.operators.search import page_of_row
from firstlight.plans.dashboard import realtime_hour, realtime_hour_of, realtime_total, realtime_total_of, sale_detail_response
from firstlight.session import build_session
from firstlight.sources.logs import read_file_log_stream, read_kafka_log_stream
from firstlight.sources.store import StorePaths, read_days
from firstlight.streaming.first_seen import has_first_seen, read_first_seen, read_new_devices, start_first_seen, update_first_seen
from firstlight.streaming.launches import start_hourly_counts
from firstlight.streaming.pipeline import start_pipeline, start_state_pipeline
from firstlight.streaming.progress import BatchTimes
from firstlight.streaming.sinks import land_raw_stream, quarantine_stream, route_stream_to_files, route_stream_to_kafka, start_ingest
from firstlight.streaming.upsert import compact, read_hours


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="firstlight")
    jobs = parser.add_subparsers(dest="job", required=True)

    def stream(name: str, *required: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        source = p.add_mutually_exclusive_group(required=True)
        source.add_argument("--files", help="folder of text log files")
        source.add_argument("--kafka", help="bootstrap servers")
        p.add_argument("--topic", default="app_log")
        p.add_argument("--group")
        p.add_argument("--partitions", type=int, help="number of the topic's partitions; those not in the ledger start at their beginning")
        p.add_argument("--max-per-trigger", type=int)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--trigger", default="5 seconds", help="interval, or 'drain' to stop at the end of input")
        for r in required:
            p.add_argument(r, required=True)
        return p

    stream("land", "--out")
    stream("route-files", "--out")
    stream("route-kafka", "--to")
    stream("quarantine", "--out")
    for name in ("pipeline", "state-pipeline"):
        p = stream(name, "--root")
        p.add_argument("--tz", default="UTC")
        p.add_argument("--minute", choices=["zero", "event"], default="zero")
        if name == "pipeline":
            p.add_argument("--keep", choices=["earliest", "arrival"], default="earliest")
            p.add_argument("--expire", help="with --keep arrival: life of a day's set of devices from its first insert, such as '24 hours'")
            p.add_argument("--times", help="folder for a table of batch times")
        else:
            p.add_argument("--expire", default="24 hours")
    p = stream("ingest", "--out")
    p = stream("first-seen-stream", "--root")
    p.add_argument("--tz", default="UTC")
    p = stream("launches-hourly", "--out")
    p.add_argument("--tz", default="UTC")
    p = jobs.add_parser("sale-detail-table")
    for r in ("--lines", "--users", "--skus", "--table"):
        p.add_argument(r, required=True, help="folder of Parquet files")
    p.add_argument("--parts", type=int, help="ranges over all days")
    p = jobs.add_parser("sale-detail")
    p.add_argument("--table", required=True)
    p.add_argument("--date", default=DEFAULT_SALE_DATE)
    p.add_argument("--keyword", default="")
    p.add_argument("--level", type=int)
    p.add_argument("--draw", type=int, default=1)
    p.add_argument("--start", type=int, default=0, help="row offset of the grid")
    p.add_argument("--length", type=int, default=PAGE_SIZES[0])
    for name in ("compact", "first-seen", "realtime-total", "realtime-hour"):
        p = jobs.add_parser(name)
        p.add_argument("--root", required=True)
        p.add_argument("--date", required=True)
        if name.startswith("realtime"):
            p.add_argument("--from-sums", action="store_true", help="from the sums of 'pipeline' and 'first-seen-stream', without reading records")
    return parser


def _logs(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.files:
        return read_file_log_stream(spark, a.files, topic=a.topic, max_bytes=a.max_per_trigger)
    offsets = {"max_per_trigger": a.max_per_trigger}
    if a.group:
        offsets["group"] = a.group
    if getattr(a, "root", None):
        # A new checkpoint starts where the ledger ends; an existing one ignores it.
        offsets["offsets"] = resolve_start(read_ledger(spark, StorePaths(a.root)), a.topic, range(a.partitions) if a.partitions else None)
    return read_kafka_log_stream(spark, a.kafka, a.topic, **offsets)


def run(argv: Sequence[str], spark: SparkSession | None = None) -> str | None:
    """Run a job; the report jobs give (and the command line prints) their JSON body."""
    a = _parser().parse_args(argv)
    spark = spark or build_session()
    trigger = None if getattr(a, "trigger", None) == "drain" else getattr(a, "trigger", None)
    if a.job == "land":
        land_raw_stream(_logs(spark, a), a.out, a.checkpoint, trigger).awaitTermination()
    elif a.job == "route-files":
        route_stream_to_files(_logs(spark, a), a.out, a.checkpoint, trigger).awaitTermination()
    elif a.job == "route-kafka":
        route_stream_to_kafka(_logs(spark, a), a.to, a.checkpoint, trigger).awaitTermination()
    elif a.job == "quarantine":
        quarantine_stream(_logs(spark, a), a.out, a.checkpoint, trigger).awaitTermination()
    elif a.job == "pipeline":
        if a.times:
            spark.streams.addListener(BatchTimes(spark, a.times))
        query = start_pipeline(_logs(spark, a), a.root, a.checkpoint, a.keep, a.tz, a.minute, trigger, expire=a.expire)
        query.awaitTermination()
    elif a.job == "ingest":
        start_ingest(_logs(spark, a), a.out, a.checkpoint, trigger).awaitTermination()
    elif a.job == "first-seen-stream":
        start_first_seen(_logs(spark, a), a.root, a.checkpoint, a.tz, trigger).awaitTermination()
    elif a.job == "launches-hourly":
        start_hourly_counts(usable(parse_logs(_logs(spark, a).select("value"))), a.out, a.checkpoint, tz=a.tz, trigger=trigger).awaitTermination()
    elif a.job == "sale-detail-table":
        detail, users, skus = (spark.read.parquet(path) for path in (a.lines, a.users, a.skus))
        write_sale_detail(build_sale_detail(detail, users, skus), a.table, a.parts)
    elif a.job == "sale-detail":
        page = page_of_row(a.start, a.length)
        return sale_detail_response(spark, a.table, a.draw, page, a.length, a.date, a.keyword, a.level).first()["body"]
    elif a.job == "state-pipeline":
        query = start_state_pipeline(_logs(spark, a), a.root, a.checkpoint, a.expire, a.tz, a.minute, trigger)
        query.awaitTermination()
    else:
        return _report(spark, StorePaths(a.root), a.job, a.date, getattr(a, "from_sums", False))
    return None


def _report(spark: SparkSession, store: StorePaths, job: str, date: str, from_sums: bool) -> str | None:
    if job == "compact":
        compact(spark, store, date)
        return None
    if job == "first-seen":
        update_first_seen(spark, store, date)
        return None
    if from_sums:
        hours = read_hours(spark, store)
        if job == "realtime-hour":
            return realtime_hour_of(compare_hours(hours, date)).first()["body"]
        return realtime_total_of(kpi_of_sums(hours, read_new_devices(spark, store), date)).first()["body"]
    if job == "realtime-total":
        # Without the day's first-seen partition new devices are counted from the whole store.
        built = has_first_seen(spark, store, date)
        body = realtime_total(read_days(spark, store, [date] if built else None), date, read_first_seen(spark, store) if built else None)
    else:
        yesterday = spark.range(1).select(previous_day(date)).first()[0]
        body = realtime_hour(read_days(spark, store, [yesterday, date]), date)
    return body.first()["body"]


if __name__ == "__main__":
    import sys

    print(run(sys.argv[1:]) or "done")
