import json
import random
from collections import Counter, defaultdict

import pytest
from helpers import rows
from pyspark.sql import functions as F

from firstlight.operators import metrics
from firstlight.plans import dashboard

SCHEMA = "dt string, mid string, hr string"


@pytest.fixture(scope="module")
def sample():
    rnd = random.Random(5)
    days = [f"2024-02-{d:02d}" for d in (26, 27, 29)] + ["2024-03-01"]
    out = []
    for _ in range(600):
        mid = "hot" if rnd.random() < 0.33 else f"m{rnd.randrange(60)}"
        out.append((rnd.choice(days), mid, f"{rnd.randrange(24):02d}"))
    return out


@pytest.fixture(scope="module")
def launched(spark, sample):
    return spark.createDataFrame(sample, SCHEMA)


def first_hours(sample):
    first = {}
    for dt, mid, hr in sample:
        first[dt, mid] = min(hr, first.get((dt, mid), "99"))
    return first


def test_total_and_hours(launched, sample):
    first = first_hours(sample)
    assert dict(rows(metrics.dau_total(launched))) == Counter(dt for dt, _ in first)
    hours = Counter((dt, hr) for (dt, _), hr in first.items())
    assert {(d, h): n for d, h, n in rows(metrics.dau_hour(launched))} == hours
    one = "2024-02-27"
    assert rows(metrics.dau_total(launched, one)) == [(one, sum(1 for d, _ in first if d == one))]
    assert rows(metrics.dau_total(launched, "1999-01-01")) == [("1999-01-01", 0)]
    assert {h: n for _, h, n in rows(metrics.dau_hour(launched, one))} == {h: n for (d, h), n in hours.items() if d == one}


def test_compare_has_24_rows_and_crosses_the_month(launched, sample):
    first = first_hours(sample)
    got = rows(metrics.hourly_compare(launched, "2024-03-01"), "hr", "today_n", "yesterday_n")
    assert [h for h, _, _ in got] == [f"{h:02d}" for h in range(24)]
    for h, today, yesterday in got:
        assert today == sum(1 for (d, _), x in first.items() if d == "2024-03-01" and x == h)
        assert yesterday == sum(1 for (d, _), x in first.items() if d == "2024-02-29" and x == h)
    empty = rows(metrics.hourly_compare(launched, "2030-01-01"))
    assert len(empty) == 24 and all(r[1:] == (0, 0) for r in empty)


def test_cumulative_ends_at_the_total(launched):
    total = dict(rows(metrics.dau_total(launched)))
    cumulative = metrics.dau_cumulative(metrics.dau_hour(launched))
    assert cumulative.count() == 24 * len(total)
    assert dict(rows(cumulative.filter("hr = '23'"), "dt", "total_n")) == total


def test_new_devices_and_kpis(spark, launched, sample):
    first_day = {}
    for dt, mid, _ in sample:
        first_day[mid] = min(dt, first_day.get(mid, "9"))
    new = Counter(first_day.values())
    assert dict(rows(metrics.new_devices(launched))) == new
    day = "2024-02-27"
    expected = [("dau", len({m for d, m, _ in sample if d == day})), ("new_mid", new[day])]
    assert rows(metrics.kpi_totals(launched, day), "id", "value") == expected
    seen = metrics.first_days(launched).withColumn("dt", F.col("dt").cast("string"))
    assert rows(metrics.kpi_totals(launched, day, seen), "id", "value") == expected
    assert rows(metrics.kpi_totals(launched, "1999-01-01"), "id", "value") == [("dau", 0), ("new_mid", 0)]
    assert rows(metrics.kpi_totals(launched, "1999-01-01", seen), "id", "value") == [("dau", 0), ("new_mid", 0)]


def test_daily_kpis_agree_with_the_single_ones(launched):
    daily = metrics.daily_kpis(launched).withColumn("dt", F.col("dt").cast("string"))
    new = dict(rows(metrics.new_devices(launched)))
    total, count = dict(rows(metrics.dau_total(launched))), dict(rows(metrics.launch_count(launched)))
    assert rows(daily, "dt", "dau", "launches", "new_mid") == [(d, total[d], count[d], new.get(d, 0)) for d in sorted(total)]
    assert metrics.kpi_series(daily).count() == 3 * len(total)


def test_day_over_day_reads_its_input_once(launched):
    df = metrics.kpi_day_over_day(metrics.kpi_series(metrics.daily_kpis(launched)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan


def test_launch_count(launched, sample):
    assert dict(rows(metrics.launch_count(launched))) == Counter(d for d, _, _ in sample)


def test_day_over_day_fills_the_gap(spark):
    daily = spark.createDataFrame([("k", "2024-02-27", 50), ("k", "2024-02-29", 30), ("k", "2024-03-01", 45)], "id string, dt string, value long")
    assert rows(metrics.kpi_day_over_day(daily), "dt", "value", "previous", "change_pct") == [
        ("2024-02-27", 50, None, None),
        ("2024-02-28", 0, 50, -100.0),
        ("2024-02-29", 30, 0, None),
        ("2024-03-01", 45, 30, 50.0),
    ]


def test_terms_agg_ties_by_value(spark):
    df = spark.createDataFrame([(c,) for c in "bbaaccd"], "c string")
    assert [tuple(r) for r in metrics.terms_agg(df, "c", 3).collect()] == [("a", 2), ("b", 2), ("c", 2)]


def test_date_and_text_days_agree(launched):
    as_date = launched.select(F.to_date("dt").alias("dt"), "mid", F.col("hr").cast("int").alias("hr"))
    for f in (metrics.dau_total, metrics.dau_hour, metrics.new_devices, metrics.launch_count):
        assert rows(f(as_date)) == rows(f(launched))
    assert rows(metrics.hourly_compare(as_date, "2024-03-01")) == rows(metrics.hourly_compare(launched, "2024-03-01"))


def test_aggregates_are_hash_aggregates(launched):
    as_date = launched.select(F.to_date("dt").alias("dt"), "mid", F.col("hr").cast("int").alias("hr"))
    for df in (metrics.dau_total(as_date), metrics.dau_hour(as_date), metrics.new_devices(as_date), metrics.kpi_totals(as_date, "2024-02-27")):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_pct(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "name string, value long")
    assert rows(metrics.with_pct(df)) == [("a", 1, 25.0), ("b", 3, 75.0)]


def test_json_bodies(launched, sample):
    day, before = "2024-03-01", "2024-02-29"
    kpis = json.loads(dashboard.realtime_total(launched, day).first()["body"])
    assert [k["id"] for k in kpis] == ["dau", "new_mid"] and set(kpis[0]) == {"id", "name", "value"}
    body = json.loads(dashboard.realtime_hour(launched, day).first()["body"])
    want = defaultdict(Counter)
    for (d, _), h in first_hours(sample).items():
        want[d][h] += 1
    assert body == {"today": want[day], "yesterday": want[before]}
    assert json.loads(dashboard.realtime_hour(launched, "2030-01-01").first()["body"]) == {"today": {}, "yesterday": {}}
