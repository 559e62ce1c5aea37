import json

import pytest
from helpers import log, ms, rows
from pyspark.sql import functions as F

from firstlight.functions.labels import thousands
from firstlight.jobs import run
from firstlight.session import cluster_settings
from firstlight.sources.store import StorePaths, read_days


def test_jobs_end_to_end(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    bodies = [
        log("a", ms("2024-01-01 10:00"), start={}),
        log("a", ms("2024-01-01 08:00"), start={}),
        log("a", ms("2024-01-02 09:00")),
        log("b", ms("2024-01-02 09:30")),
        "broken {",
    ]
    (source / "x.txt").write_text("\n".join(bodies) + "\n")
    p = lambda name: str(tmp_path / name)
    stream = lambda job, name, *more: run(
        [job, "--files", str(source), "--checkpoint", p("cp-" + name), "--trigger", "drain", *more], spark
    )
    stream("land", "land", "--out", p("landed"))
    stream("route-files", "route", "--out", p("routed"))
    stream("quarantine", "bad", "--out", p("bad"))
    assert spark.read.text(p("landed")).count() == 5
    assert spark.read.text(p("routed")).filter("topic = 'start_log'").count() == 2
    assert rows(spark.read.parquet(p("bad")), "value") == [("broken {",)]
    for job, root in (("pipeline", p("store")), ("state-pipeline", p("store2"))):
        stream(job, job, "--root", root)
        stored = read_days(spark, StorePaths(root))
        assert rows(stored, "dt", "mid", "hr") == [("2024-01-01", "a", "08"), ("2024-01-02", "a", "09"), ("2024-01-02", "b", "09")]
        for day in ("2024-01-01", "2024-01-02"):
            run(["compact", "--root", root, "--date", day], spark)
            run(["first-seen", "--root", root, "--date", day], spark)
        kpis = json.loads(run(["realtime-total", "--root", root, "--date", "2024-01-02"], spark))
        assert [(k["id"], k["value"]) for k in kpis] == [("dau", 2), ("new_mid", 1)]
        hours = json.loads(run(["realtime-hour", "--root", root, "--date", "2024-01-02"], spark))
        assert hours == {"yesterday": {"08": 1}, "today": {"09": 2}}


def test_a_source_is_needed():
    with pytest.raises(SystemExit):
        run(["land", "--out", "x", "--checkpoint", "y"])


def test_settings_and_labels(spark):
    big = cluster_settings(4000, 100 * 2**40)
    assert int(big["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) == 819_200
    assert cluster_settings(8, 2**30)["spark.sql.shuffle.partitions"] == "24"
    assert spark.range(2702, 2703).select(thousands(F.col("id"))).first()[0] == "2,702"


def test_jobs_of_sums_ingest_and_grid(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    bodies = [log("a", ms("2024-01-01 10:00"), start={}), log("a", ms("2024-01-02 09:00")), log("b", ms("2024-01-02 09:30")), "broken {"]
    (source / "x.txt").write_text("\n".join(bodies) + "\n")
    p = lambda name: str(tmp_path / name)
    stream = lambda job, *more: run([job, "--files", str(source), "--checkpoint", p("cp-" + job), "--trigger", "drain", *more], spark)
    stream("ingest", "--out", p("out"))
    assert spark.read.text(p("out") + "/sink=raw").count() == 4 and spark.read.text(p("out") + "/sink=rejected").count() == 1
    stream("launches-hourly", "--out", p("hourly"))
    assert spark.read.parquet(p("hourly")).agg(F.sum("n")).first()[0] == 3
    stream("pipeline", "--root", p("store"), "--keep", "arrival", "--expire", "24 hours")
    stream("first-seen-stream", "--root", p("store"))
    report = lambda job: json.loads(run([job, "--root", p("store"), "--date", "2024-01-02", "--from-sums"], spark))
    assert [(k["id"], k["value"]) for k in report("realtime-total")] == [("dau", 2), ("new_mid", 1)]
    assert report("realtime-hour") == {"yesterday": {"10": 1}, "today": {"09": 2}}

    spark.createDataFrame([("1-1", 1, 1, 7, 9.5, "2019-03-04"), ("1-2", 1, 2, 7, 9.5, "2019-03-04")], "order_detail_id string, order_id long, user_id long, sku_id long, sku_price double, dt string").write.parquet(p("lines"))
    spark.createDataFrame([(1, "M", 19, 1), (2, "F", 31, 3)], "user_id long, user_gender string, user_age int, user_level int").write.parquet(p("users"))
    spark.createDataFrame([(7, "red ring", "t1")], "sku_id long, sku_name string, sku_tm_id string").write.parquet(p("skus"))
    run(["sale-detail-table", "--lines", p("lines"), "--users", p("users"), "--skus", p("skus"), "--table", p("grid"), "--parts", "2"], spark)
    body = json.loads(run(["sale-detail", "--table", p("grid"), "--draw", "3", "--start", "1", "--length", "1"], spark))
    assert body["draw"] == 3 and body["data"]["total"] == 2 and [r["order_detail_id"] for r in body["data"]["detail"]] == ["1-2"]
