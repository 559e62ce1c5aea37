"""Figures that batches keep up to date: hours, first days, expiring sets, counts of batches, hourly launches."""

import os
import random
import time
from datetime import datetime, timedelta

import pytest
from helpers import log, ms, records, rows
from pyspark.sql import functions as F

from firstlight.operators import metrics
from firstlight.operators.ingest import usable, parse_logs
from firstlight.schemas import BATCH_TIMES, DAY_SUMS, RAW_LOG
from firstlight.sources import folders
from firstlight.sources.logs import read_file_log_stream
from firstlight.sources.store import StorePaths, get_device, init_store, read_day, read_days
from firstlight.sources.sums import fold_sums, read_sums, write_changes
from firstlight.streaming import first_seen, launches, pipeline, sinks
from firstlight.streaming.epochs import fold_seen, read_epochs, read_seen
from firstlight.streaming.progress import BatchTimes, late_batches, read_batch_times
from firstlight.streaming.state import first_per_day_stream
from firstlight.streaming.upsert import compact, current, read_hours, upsert_by_key


def made(spark, seed, n=300, devices=20, days=4):
    rnd = random.Random(seed)
    start = ms("2024-01-01 00:00")
    data = [(f"m{rnd.randrange(devices)}" if rnd.random() > 0.3 else "hot", start + rnd.randrange(days * 86_400_000), rnd.choice("xyz")) for _ in range(n)]
    return data, lambda some: records(spark, some)


# ---------------------------------------------------------------- sums


def test_sums_fold_and_retry(spark, tmp_path):
    path, add = str(tmp_path / "s"), lambda some: spark.createDataFrame(some, "dt string, n long")
    total = lambda: dict(rows(read_sums(spark, path, DAY_SUMS, ["dt"])))
    assert total() == {}
    for b in range(4):
        write_changes(add([("a", 1), ("a", 2), ("b", b), ("c", 1 if b % 2 else -1)]), path, b, ["dt"])
    assert total() == {"a": 12, "b": 6}
    write_changes(add([("a", 5)]), path, 3, ["dt"])  # the last batch again, with other rows
    assert total() == {"a": 14, "b": 3, "c": -1}
    held = read_sums(spark, path, DAY_SUMS, ["dt"])
    fold_sums(spark, path, DAY_SUMS, ["dt"], 2)
    fold_sums(spark, path, DAY_SUMS, ["dt"], 2)
    assert total() == dict(rows(held)) == {"a": 14, "b": 3, "c": -1}
    write_changes(add([("c", 1)]), path, 4, ["dt"])
    fold_sums(spark, path, DAY_SUMS, ["dt"], 4, grace=0)  # removes what the fold before replaced
    assert total() == {"a": 14, "b": 3}
    assert folders.numbers(spark, f"{path}/changes", "batch_id") == [3, 4]


def test_a_fold_that_died_counts_nothing_twice(spark, tmp_path):
    path = str(tmp_path / "s")
    write_changes(spark.createDataFrame([("a", 1)], "dt string, n long"), path, 0, ["dt"])
    write_changes(spark.createDataFrame([("a", 1)], "dt string, n long"), path, 1, ["dt"])
    spark.createDataFrame([("a", 2)], "dt string, n long").write.parquet(f"{path}/sums/upto=1")
    assert rows(read_sums(spark, path, DAY_SUMS, ["dt"])) == [("a", 2)]
    folders.remove(spark, [f"{path}/sums/upto=1/_SUCCESS"])  # not committed
    assert rows(read_sums(spark, path, DAY_SUMS, ["dt"])) == [("a", 2)]


# ---------------------------------------------------------------- hours


def test_hours_move_with_earlier_launches(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    data, of = made(spark, 1)
    parts = [data[200:], data[:120], data[80:220], data[:50]]
    for b, part in enumerate(parts):
        upsert_by_key(of(part), b, store)
        want = metrics.dau_hour(of([r for p in parts[: b + 1] for r in p]))
        assert rows(read_hours(spark, store), "dt", "hr", "n") == rows(want, "dt", "hr", "n")
    upsert_by_key(of(parts[3]), 3, store)  # retried
    assert rows(read_hours(spark, store), "dt", "hr", "n") == rows(want, "dt", "hr", "n")
    assert all("/hours/" in f for f in read_hours(spark, store).inputFiles())


def test_dashboards_from_the_sums(spark, tmp_path):
    from firstlight.plans import dashboard

    store = StorePaths(str(tmp_path))
    data, of = made(spark, 5)
    data.sort(key=lambda r: -r[1])
    for b, part in enumerate((data[:150], data[150:])):
        upsert_by_key(of(part), b, store)
        first_seen.merge_first_seen(of(part), b, store, buckets=2)
    body = lambda df: df.first()["body"]
    hours, new = read_hours(spark, store), first_seen.read_new_devices(spark, store)
    for day in ("2024-01-01", "2024-01-03", "2024-02-01"):
        assert body(dashboard.realtime_hour_of(metrics.compare_hours(hours, day))) == body(dashboard.realtime_hour(of(data), day))
        assert body(dashboard.realtime_total_of(metrics.kpi_of_sums(hours, new, day))) == body(dashboard.realtime_total(of(data), day))


def test_hours_of_arrivals_never_move(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    upsert_by_key(records(spark, [("a", ms("2024-01-01 12:00"), "x")]), 0, store, keep="arrival")
    upsert_by_key(records(spark, [("a", ms("2024-01-01 06:00"), "x"), ("b", ms("2024-01-01 06:00"), "x")]), 1, store, keep="arrival")
    assert rows(read_hours(spark, store)) == [("2024-01-01", "06", 1), ("2024-01-01", "12", 1)]


def test_counts_of_a_batch(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    late, early = ("a", ms("2024-01-01 12:00"), "x"), ("a", ms("2024-01-01 06:00"), "x")
    assert upsert_by_key(records(spark, [late, ("b", ms("2024-01-02 01:00"), "x")]), 0, store) == {"written": 2, "added": 2, "days": 2}
    assert upsert_by_key(records(spark, [early]), 1, store) == {"written": 1, "added": 0, "days": 1}
    assert upsert_by_key(records(spark, [late]), 2, store) == {"written": 0, "added": 0, "days": 0}


# ---------------------------------------------------------------- store


def test_a_batch_reads_its_own_days_only(spark, tmp_path):
    """300 stored days, a batch of two: no other folder is listed or scanned."""
    store = StorePaths(str(tmp_path))
    init_store(spark, store)
    old = records(spark, [(f"d{i}", ms("2023-01-01 10:00") + i * 86_400_000, "x") for i in range(300)])
    upsert_by_key(old, 0, store)
    files = read_days(spark, store, ["2023-02-01", "2023-02-03", "2025-01-01"]).inputFiles()
    assert len(files) == 3 and all(any(f"/dt={d}/" in f for d in ("none", "2023-02-01", "2023-02-03")) for f in files)
    begun = time.time()
    upsert_by_key(records(spark, [("d31", ms("2023-02-01 08:00"), "x"), ("n", ms("2023-02-03 08:00"), "x")]), 1, store)
    few = time.time() - begun
    assert rows(current(read_days(spark, store, ["2023-02-01"])), "mid", "hr") == [("d31", "08")]
    assert read_days(spark, store).count() == 302 and few < 60


def test_a_held_reader_survives_a_fold(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    data, of = made(spark, 2, days=1)
    for b in range(3):
        upsert_by_key(of(data[b * 100 : b * 100 + 100]), b, store)
    held = read_day(spark, store, "2024-01-01")
    held.count()
    compact(spark, store, "2024-01-01")
    compact(spark, store, "2024-01-01")
    want = rows(metrics.dau_hour(of(data)))
    assert rows(metrics.dau_hour(held)) == want == rows(metrics.dau_hour(read_day(spark, store, "2024-01-01")))
    upsert_by_key(of(data[:10]), 3, store)
    compact(spark, store, "2024-01-01", grace=0)
    assert len(folders.numbers(spark, f"{store.dau}/dt=2024-01-01", "batch_id", committed=False)) == 1
    assert rows(metrics.dau_hour(read_day(spark, store, "2024-01-01"))) == want


def test_one_device_is_read_from_its_row_group(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    many = spark.range(60_000).selectExpr("concat('m', lpad(id, 6, '0')) mid", f"{ms('2024-01-01 10:00')} + id ts", "'x' ch")
    from firstlight.operators.ingest import to_dau_info

    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(64 << 10))
    conf.set("parquet.page.row.count.limit", "2000")
    try:
        for b in range(2):
            upsert_by_key(to_dau_info(many.filter(f"id % 2 = {b}").selectExpr("*", "'u' uid", "'a' ar", "'v' vc")), b, store)
        compact(spark, store, "2024-01-01", grace=0)
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.row.count.limit")
    found = get_device(spark, store, "2024-01-01", "m031234")
    assert [(r["mid"], r["ts"]) for r in found.collect()] == [("m031234", ms("2024-01-01 10:00") + 31234)]
    plan = found._jdf.queryExecution().executedPlan()
    while plan.children().size() or plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.children().apply(0) if plan.children().size() else plan.executedPlan()
    read = plan.metrics().apply("numOutputRows").value()
    assert 1 <= read < 60_000 // 4, read


# ---------------------------------------------------------------- first days


def test_first_days_correct_themselves(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    data, of = made(spark, 3, devices=40, days=6)
    data.sort(key=lambda r: -r[1])
    parts = [data[:100], data[100:200], data[200:], data[50:150]]
    for b, part in enumerate(parts):
        first_seen.merge_first_seen(of(part), b, store, buckets=4)
        sofar = of([r for p in parts[: b + 1] for r in p])
        assert rows(first_seen.read_new_devices(spark, store)) == rows(metrics.new_devices(sofar))
        if b == 2:
            first_seen.fold_first_seen(spark, store, 3, buckets=4)
            assert rows(first_seen.read_new_devices(spark, store)) == rows(metrics.new_devices(sofar))
            name = first_seen.device_days(spark, store, 4)
            assert rows(spark.table(name), "mid", "dt") == rows(metrics.first_days(sofar).selectExpr("mid", "cast(dt as string) dt"))
    first_seen.merge_first_seen(of(parts[3]), 3, store, buckets=4)  # retried
    first_seen.fold_first_seen(spark, store, 4, buckets=4, grace=0)
    assert rows(first_seen.read_new_devices(spark, store)) == rows(metrics.new_devices(sofar))


def test_history_is_not_shuffled(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    data, of = made(spark, 4)
    first_seen.merge_first_seen(of(data[:200]), 0, store, buckets=4)
    first_seen.merge_first_seen(of(data[100:]), 1, store, buckets=4)
    history = spark.table(first_seen.device_days(spark, store, 4)).filter("batch_id < 2")
    plan = first_seen.earlier_days(of(data), history, 4)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    indent = lambda line: len(line) - len(line.lstrip(" +-:|"))
    branch = [line for i, line in enumerate(lines) if join < i <= scan]
    last = max(i for i, line in enumerate(branch) if indent(line) == indent(lines[join]) + 3)
    assert not any("Exchange" in line for line in branch[last:])


def test_first_days_of_a_stream(spark, tmp_path):
    values = [log(f"m{i % 7}", ms("2024-01-05 10:00") - i * 86_400_000 // 4) for i in range(20)] + ["broken {"]
    feed = str(tmp_path / "in")
    for i in range(2):
        some = spark.createDataFrame([(v, "t", 0, 0) for v in values[i::2]], RAW_LOG)
        some.coalesce(1).write.mode("append").parquet(feed)
    logs = read_file_log_stream(spark, feed, fmt="parquet", max_files=1)
    first_seen.start_first_seen(logs, str(tmp_path / "s"), str(tmp_path / "c"), trigger=None, buckets=2, fold_every=1).awaitTermination()
    whole = spark.createDataFrame([(v,) for v in values], "value string")
    want = metrics.new_devices(metrics.launches(usable(parse_logs(whole))))
    assert rows(first_seen.read_new_devices(spark, StorePaths(str(tmp_path / "s")))) == rows(want)


# ---------------------------------------------------------------- expiry


def arrive(spark, store, batch_id, mids, at, days=("2024-01-01",), expire="24 hours"):
    bodies = [log(m, ms(f"{d} 10:00")) for d in days for m in mids]
    df = spark.createDataFrame([(b, "t", 0, None, at) for b in bodies], "value string, topic string, partition int, offset long, arrived_at timestamp")
    pipeline.process_batch(df, batch_id, store, keep="arrival", expire=expire)
    return rows(read_days(spark, store).filter(F.col("batch_id") == batch_id), "dt", "mid")


def test_a_set_ends_a_day_after_its_first_insert(spark, tmp_path):
    store, t = StorePaths(str(tmp_path)), datetime(2024, 6, 1, 22, 30)
    hour = timedelta(hours=1)
    one = lambda *mids: [("2024-01-01", m) for m in mids]
    assert arrive(spark, store, 0, ["a"], t) == one("a")
    assert arrive(spark, store, 1, ["a", "b"], t + 23 * hour) == one("b")
    assert arrive(spark, store, 2, ["a", "b"], t + 24 * hour - timedelta(seconds=1)) == []
    # Past 24 hours the whole set is gone, however lately a device came; another day's set has a life of its own.
    assert arrive(spark, store, 3, ["a", "b"], t + 24 * hour) == one("a", "b")
    assert arrive(spark, store, 4, ["a"], t + 26 * hour, ("2024-01-01", "2024-01-02")) == [("2024-01-02", "a")]
    assert arrive(spark, store, 4, ["a"], t + 26 * hour, ("2024-01-01", "2024-01-02")) == [("2024-01-02", "a")]  # retried
    # A clock that steps back neither ends a set nor loses a row.
    assert arrive(spark, store, 5, ["a", "c"], t - hour) == one("c")
    fold_seen(spark, store, "2024-01-01", below=6, grace=0)
    fold_seen(spark, store, "2024-01-01", below=6, grace=0)
    assert arrive(spark, store, 6, ["a", "b", "c", "d"], t + 47 * hour) == one("d")
    assert arrive(spark, store, 7, ["a", "b"], t + 48 * hour, ("2024-01-01", "2024-01-02")) == [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "b")]
    assert rows(read_epochs(spark, store), "dt", "epoch") == [("2024-01-01", 0), ("2024-01-01", 3), ("2024-01-01", 7), ("2024-01-02", 4)]
    assert folders.numbers(spark, f"{store.seen}/dt=2024-01-01", "epoch", committed=False) == [3, 7]
    assert rows(read_seen(spark, store, [("2024-01-01", 7)]), "mid") == [("a",), ("b",)]


def test_expiry_in_a_stream(spark, tmp_path):
    feed, store = str(tmp_path / "in"), StorePaths(str(tmp_path / "s"))
    body = spark.createDataFrame([(log("a", ms("2024-01-01 10:00")), "t", 0, None)], RAW_LOG)

    def run():
        body.coalesce(1).write.mode("append").parquet(feed)
        logs = read_file_log_stream(spark, feed, fmt="parquet", max_files=1)
        pipeline.start_pipeline(logs, store.root, str(tmp_path / "c"), keep="arrival", trigger=None, expire="5 seconds").awaitTermination()
        return read_days(spark, store).count()

    assert run() == 1
    time.sleep(6)
    assert run() == 2
    with pytest.raises(ValueError):
        pipeline.process_batch(body, 9, store, keep="earliest", expire="1 hour")


def test_state_has_room_for_a_clock_that_steps_back(spark, tmp_path):
    """The watermark of arrivals stays behind the newest one by the room given."""
    src = spark.readStream.format("rate").load().selectExpr("'a' mid", "'u' uid", "'x' ar", "'x' ch", "'v' vc", "'2024-01-01' dt", "'00' hr", "'00' mi", "value ts")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "EventTimeWatermark" in plan(first_per_day_stream(src)) and "1 hours" in plan(first_per_day_stream(src))
    assert "3 hours" in plan(first_per_day_stream(src, room="3 hours"))


# ---------------------------------------------------------------- batches


def test_batches_count_themselves(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    bodies = [log("a", ms("2024-01-01 10:00")), log("a", ms("2024-01-01 09:00")), log("b", ms("2024-01-02 09:00")), "broken {", log(None, 5)]
    batch = spark.createDataFrame([(b, "t", 0, None) for b in bodies], RAW_LOG)
    seen = []
    pipeline.process_batch(batch, 0, store, on_metrics=seen.append)
    pipeline.process_batch(batch, 1, store, on_metrics=seen.append)
    pipeline.process_batch(batch.filter("value like 'broken%'"), 2, store)
    pipeline.process_batch(batch.limit(0), 3, store)
    pipeline.process_batch(batch, 1, store)  # retried
    got = rows(pipeline.read_batches(spark, store), "batch_id", "logs", "rejected", "written", "added", "days")
    assert got == [(0, 5, 2, 2, 2, 2), (1, 5, 2, 0, 0, 0), (2, 1, 1, 0, 0, 0), (3, 0, 0, 0, 0, 0)]
    assert seen == [{"batch_id": 0, "days": 2, "written": 2}, {"batch_id": 1, "days": 0, "written": 0}]
    assert all("/batches/" in f for f in pipeline.read_batches(spark, store).inputFiles())


def test_a_trigger_of_five_seconds_is_held(spark, tmp_path):
    feed, times = str(tmp_path / "in"), str(tmp_path / "times")
    for i in range(5):
        some = spark.createDataFrame([(log(f"m{i}-{j}", ms("2024-01-01 10:00")), "t", 0, j) for j in range(500)], RAW_LOG)
        some.coalesce(1).write.mode("append").parquet(feed)
    listener = BatchTimes(spark, times)
    spark.streams.addListener(listener)
    try:
        logs = read_file_log_stream(spark, feed, fmt="parquet", max_files=1)
        query = launches.start_hourly_counts(usable(parse_logs(logs.select("value"))), str(tmp_path / "out"), str(tmp_path / "c"), trigger="5 seconds")
        wanted = str(query.id)
        deadline = time.time() + 90
        seen = lambda: rows(read_batch_times(spark, times, wanted), "batch_id", "rows", "started", "trigger_ms")
        while time.time() < deadline and len(seen()) < 5:
            time.sleep(1)
        query.stop()
    finally:
        spark.streams.removeListener(listener)
    got = seen()
    assert [(b, n) for b, n, _, _ in got[:5]] == [(i, 500) for i in range(5)]
    # From the second batch on: the first one compiles everything.
    assert all(took < 5000 for _, _, _, took in got[1:5])
    gaps = [(y - x).total_seconds() for (_, _, x, _), (_, _, y, _) in zip(got[1:5], got[2:5])]
    assert all(4 < g < 6 for g in gaps)
    assert late_batches(spark.createDataFrame([("q", None, 0, 1, 6000, 1)], BATCH_TIMES), 5000).count() == 1


# ---------------------------------------------------------------- one-pass ingest


def test_three_sinks_from_one_parse(spark, tmp_path):
    root = str(tmp_path / "out")
    bodies = [log("a", 1, start={}), log("b", 2), '{"common": {"mid": "c"},\n "ts": 3}', "broken {", log("d", "x"), None]
    batch = spark.createDataFrame([(b, "2024-01-0" + str(1 + i % 2)) for i, b in enumerate(bodies)], "value string, ingest_date string")
    plan = sinks.outputs(batch)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    for _ in range(2):  # the second is a retry
        sinks.ingest_batch(batch, 7, root)
    one = '{"common": {"mid": "c"},  "ts": 3}'.replace("  ", " " * 2)
    raw = [v for v, in rows(sinks.read_ingested(spark, root, sinks.RAW), "value")]
    assert len(raw) == 5 and one in raw
    topics = rows(sinks.read_ingested(spark, root, sinks.TOPICS), "part", "value")
    assert topics == sorted([("start_log", bodies[0]), ("event_log", bodies[1]), ("event_log", one), ("event_log", bodies[4])])
    assert rows(sinks.read_ingested(spark, root, sinks.REJECTED), "part", "value") == [("bad_json", "broken {"), ("no_ts", bodies[4])]


def test_ingest_streams_keep_bodies_whole(spark, tmp_path):
    feed = str(tmp_path / "in")
    body = '{"common": {"mid": "a"},\r\n\n "start": {},\n "ts": 5}'
    spark.createDataFrame([(body, "t", 0, 0), (log("b", 6), "t", 0, 1)], RAW_LOG).coalesce(1).write.parquet(feed)
    logs = lambda: read_file_log_stream(spark, feed, fmt="parquet", max_files=1)
    path = lambda n: str(tmp_path / n)
    sinks.start_ingest(logs(), path("one"), path("c1"), trigger=None).awaitTermination()
    sinks.start_ingest(logs(), path("one"), path("c1"), trigger=None).awaitTermination()
    sinks.land_raw_stream(logs(), path("raw"), path("c2"), trigger=None).awaitTermination()
    sinks.route_stream_to_files(logs(), path("routed"), path("c3"), trigger=None).awaitTermination()
    assert spark.read.text(path("raw")).count() == 2 == sinks.read_ingested(spark, path("one"), sinks.RAW).count()
    routed = spark.read.schema("value string, topic string").text(path("routed"))
    assert rows(routed, "topic") == rows(sinks.read_ingested(spark, path("one"), sinks.TOPICS), "part") == [("event_log",), ("start_log",)]
    assert routed.filter("get_json_object(value, '$.ts') = 5").count() == 1


# ---------------------------------------------------------------- hourly launches


def test_hourly_launches_in_any_order(spark, tmp_path):
    feed, out, cp = (str(tmp_path / n) for n in ("in", "out", "c"))
    rnd = random.Random(9)
    stamps = [ms("2024-01-01 00:00") + rnd.randrange(5 * 86_400_000) for _ in range(400)] + [None, 1 << 62, ms("9999-12-31 23:30")]
    for i in range(6):
        spark.createDataFrame([(t,) for t in stamps[i::6]], "ts long").coalesce(1).write.mode("append").parquet(feed)
    source = lambda: spark.readStream.schema("ts long").option("maxFilesPerTrigger", 1).parquet(feed)
    run = lambda: launches.start_hourly_counts(source(), out, cp, trigger=None, fold_every=3, grace=0).awaitTermination()
    run()
    counted = lambda: spark.createDataFrame([(t,) for t in stamps], "ts long").selectExpr("*", "'m' mid")
    want = lambda: rows(metrics.launches(counted()).filter("dt is not null").groupBy("dt", "hr").count())
    got = lambda: [(str(d), int(h), n) for d, h, n in rows(launches.read_hourly(spark, out))]
    assert got() == [(str(d), h, n) for d, h, n in want()]
    assert len(folders.names(spark, out)) < 6
    stamps.extend([ms("2024-01-01 00:10")] * 5)
    spark.createDataFrame([(t,) for t in stamps[-5:]], "ts long").coalesce(1).write.mode("append").parquet(feed)
    run()
    assert got() == [(str(d), h, n) for d, h, n in want()]


def test_hourly_state_stays_in_its_partitions(spark, tmp_path):
    """One file a batch, but a task for each partition of the state."""
    feed, out, cp = (str(tmp_path / n) for n in ("in", "out", "c"))
    spark.range(100).selectExpr("id * 3600000 ts").coalesce(1).write.parquet(feed)
    query = launches.start_hourly_counts(spark.readStream.schema("ts long").parquet(feed), out, cp, trigger=None)
    query.awaitTermination()
    jobs = spark.sparkContext.statusTracker()
    stages = [jobs.getStageInfo(s) for j in jobs.getJobIdsForGroup(str(query.runId)) for s in jobs.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) == 4
    assert len([f for f in os.listdir(f"{out}/batch_id=0") if f.endswith(".parquet")]) == 1


def test_daily_stream_has_two_triggers(spark, tmp_path, monkeypatch):
    """However many files the events are in."""
    from firstlight.plans import catalog

    for i in range(5):
        spark.range(20).selectExpr(
            f"id + {20 * i} event_id", "timestamp_seconds(1704067200 + id * 36000) ts", "id % 7 user_id", "'view' event_type", "1.0D value", "'{}' props"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    kept = []
    scratch = catalog.scratch_dir
    monkeypatch.setattr(catalog, "scratch_dir", lambda s, name: kept.append(scratch(s, name)) or kept[-1])
    got = catalog.dau_total_stream(spark, str(tmp_path))
    assert sum(r["n"] for r in got.collect()) == 20
    arrivals = next(p for p in kept if "/arrivals-" in p).removeprefix("file:")
    # The watermark's own batch may follow each.
    assert 2 <= len([n for n in os.listdir(arrivals) if n.startswith("batch_id=")]) <= 4
