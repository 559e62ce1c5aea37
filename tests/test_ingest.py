import pytest
from helpers import log, ms, raw, rows
from pyspark.sql import functions as F

from firstlight.functions.clock import previous_day, today_text, with_dt_hr
from firstlight.functions.predicates import is_start
from firstlight.operators import ingest

BAD = {
    "not json": "bad_json",
    "": "bad_json",
    "[1]": "bad_json",
    "null": "bad_json",
    '{"common":{"mid":"a"},"ts":1': "bad_json",
    '{"common":{"mid":"a"}}': "no_ts",
    '{"common":{"mid":"a"},"ts":"soon"}': "no_ts",
    '{"common":{"mid":"a"},"ts":999999999999999999}': "no_ts",
    '{"ts":5}': "no_mid",
    '{"common":{"uid":"1"},"ts":5}': "no_mid",
}


def test_unusable_bodies_are_set_aside_with_a_reason(spark):
    good = [log("m1", 5), log("m2", "1627604275000")]
    parsed = ingest.parse_logs(raw(spark, [*BAD, *good]))
    assert dict(rows(ingest.quarantine(parsed))) == BAD
    assert rows(ingest.usable(parsed), "mid", "ts") == [("m1", 5), ("m2", 1627604275000)]


def test_body_is_parsed_once(spark):
    records = ingest.to_dau_info(ingest.usable(ingest.parse_logs(raw(spark, [log()]))))
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_routing(spark):
    bodies = {
        log(start={}): "start_log",
        log(start={"entry": "icon"}): "start_log",
        log(): "event_log",
        log(start=None): "event_log",
        log(page={"k": 1}): "event_log",
        "broken {": None,
    }
    df = raw(spark, list(bodies))
    routed = {r["value"]: r["topic"] for r in ingest.route_logs(df).collect()}
    assert routed == bodies
    other = ingest.route_logs(df, start_topic="s", event_topic="e").select("topic").distinct()
    assert {r[0] for r in other.collect()} == {"s", "e", None}
    flags = {r[0]: r[1] for r in df.select("value", is_start(F.col("value"))).collect()}
    assert all(flags[b] == (t == "start_log") for b, t in bodies.items() if t)


def test_write_routed_and_land_raw(spark, tmp_path):
    df = raw(spark, [log("a", 1, start={}), log("b", 2), "broken {"])
    ingest.write_routed(ingest.route_logs(df), str(tmp_path / "routed"))
    back = spark.read.schema("value string, topic string").text(str(tmp_path / "routed"))
    assert rows(back, "topic", "value") == [("event_log", log("b", 2)), ("start_log", log("a", 1, start={}))]
    ingest.land_raw(df.withColumn("ingest_date", F.lit("2024-01-01")), str(tmp_path / "landed"))
    landed = spark.read.schema("value string, ingest_date string").text(str(tmp_path / "landed"))
    assert {r["value"] for r in landed.collect()} == {r["value"] for r in df.collect()}


@pytest.mark.parametrize(
    "tz, expected",
    [
        ("UTC", [("2024-01-01", "23"), ("2024-01-02", "00"), ("1969-12-31", "23")]),
        ("Asia/Shanghai", [("2024-01-02", "07"), ("2024-01-02", "08"), ("1970-01-01", "07")]),
        ("America/New_York", [("2024-01-01", "18"), ("2024-01-01", "19"), ("1969-12-31", "18")]),
    ],
)
@pytest.mark.parametrize("session", ["UTC", "America/Los_Angeles"])
def test_midnight_in_the_zone_asked_for(spark, tz, expected, session):
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        stamps = [ms("2024-01-01 23:59:59.999"), ms("2024-01-02 00:00"), -1]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, ts long")
        got = [tuple(r) for r in with_dt_hr(df, "ts", tz).orderBy("i").select("dt", "hr").collect()]
        assert got == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minute_option(spark):
    df = spark.createDataFrame(
        [("m", "u", "a", "c", "v", ms("2024-01-01 10:07"))], "mid string, uid string, ar string, ch string, vc string, ts long"
    )
    assert rows(ingest.to_dau_info(df)) == [("m", "u", "a", "c", "v", "2024-01-01", "10", "00", ms("2024-01-01 10:07"))]
    assert rows(ingest.to_dau_info(df, minute="event"), "mi") == [("07",)]
    with pytest.raises(ValueError):
        ingest.to_dau_info(df, minute="second")


def test_days(spark):
    one = spark.range(1)
    assert rows(one.select(previous_day("2024-03-01"), previous_day("2024-01-01"))) == [("2024-02-29", "2023-12-31")]
    assert len(one.select(today_text().alias("d")).first()["d"]) == 10
