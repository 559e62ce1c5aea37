import random
import time

import pytest
from helpers import log, ms, rows
from pyspark.sql import functions as F

from firstlight.operators import ingest, ledger, metrics
from firstlight.operators.dedup import first_per_day
from firstlight.schemas import DAU_COLUMNS, RAW_LOG
from firstlight.sources.logs import read_file_log_stream
from firstlight.sources.store import StorePaths, read_day, read_days
from firstlight.streaming import pipeline
from firstlight.streaming.first_seen import read_first_seen, update_first_seen
from firstlight.streaming.sinks import land_raw_stream, quarantine_stream, route_stream_to_files
from firstlight.streaming.state import earliest_updates, first_per_day_stream
from firstlight.streaming.upsert import batch_metrics, compact, current, upsert_by_key


def bodies(seed=1, n=400, devices=25):
    rnd = random.Random(seed)
    start = ms("2024-01-01 00:00")
    out = []
    for _ in range(n):
        mid = "hot" if rnd.random() < 0.33 else f"m{rnd.randrange(devices)}"
        out.append(log(mid, start + rnd.randrange(3 * 86_400_000), uid=mid, ch=rnd.choice("xyz")))
    return out


class Feed:
    """A folder of Parquet log files, one per batch, with running offsets."""

    def __init__(self, spark, path):
        self.spark, self.path, self.next, self.files = spark, str(path), 0, 0

    def add(self, values):
        rows_ = [(v, "start_log", 0, self.next + i) for i, v in enumerate(values)]
        self.next += len(rows_)
        df = self.spark.createDataFrame(rows_, RAW_LOG).coalesce(1)
        df.write.parquet(f"{self.path}/f{self.files:03d}")
        self.files += 1

    def stream(self):
        return read_file_log_stream(self.spark, self.path, fmt="parquet", max_files=1)


@pytest.fixture
def env(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in")
    root, checkpoint = str(tmp_path / "store"), str(tmp_path / "cp")

    def run(keep="earliest", cp=checkpoint, **kw):
        seen = []
        q = pipeline.start_pipeline(feed.stream(), root, cp, keep=keep, trigger=None, on_metrics=seen.append, **kw)
        q.awaitTermination()
        return seen

    return feed, StorePaths(root), run, checkpoint


def batch_result(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return rows(first_per_day(ingest.to_dau_info(ingest.usable(ingest.parse_logs(df)))), *DAU_COLUMNS)


def stored(spark, store):
    return rows(current(read_days(spark, store)), *DAU_COLUMNS)


def test_stream_equals_batch_whatever_the_arrival_order(spark, env):
    feed, store, run, _ = env
    values = bodies()
    feed.add(values[200:300])
    feed.add(values[:150] + ["broken {", log(None, 5)])
    feed.add(values[100:250])  # replayed overlap
    seen = run()
    feed.add(values[250:])
    seen += run()  # resumes from the checkpoint
    assert stored(spark, store) == batch_result(spark, values)
    assert [m["batch_id"] for m in seen] == [0, 1, 2, 3]
    assert sum(m["written"] for m in seen) == read_days(spark, store).count()
    bad = spark.read.parquet(store.quarantine)
    assert rows(bad, "value", "reason") == [("broken {", "bad_json"), ('{"common": {}, "ts": 5}', "no_mid")]
    offsets = ledger.read_ledger(spark, store)
    assert rows(ledger.next_offsets(offsets, "start_log")) == [(0, feed.next)]
    ranges = rows(offsets, "batch_id", "from_offset", "until_offset")
    assert [r[1] for r in ranges[1:]] == [r[2] for r in ranges[:-1]]


def test_arrival_keeps_the_first_arrived(spark, env):
    feed, store, run, _ = env
    late, early = log("a", ms("2024-01-01 12:00"), ch="late"), log("a", ms("2024-01-01 06:00"), ch="early")
    feed.add([late])
    feed.add([early, log("b", ms("2024-01-01 07:00"))])
    run(keep="arrival")
    assert rows(read_days(spark, store), "mid", "hr") == [("a", "12"), ("b", "07")]


def test_late_record_of_an_earlier_day(spark, env):
    feed, store, run, _ = env
    feed.add([log("a", ms("2024-01-05 12:00"))])
    feed.add([log("a", ms("2024-01-05 08:00")), log("z", ms("2024-01-03 23:00"))])
    run()
    assert rows(current(read_days(spark, store)), "dt", "mid", "hr") == [("2024-01-03", "z", "23"), ("2024-01-05", "a", "08")]
    assert rows(metrics.dau_hour(read_day(spark, store, "2024-01-05"))) == [("2024-01-05", "08", 1)]


@pytest.mark.parametrize("keep", ["earliest", "arrival"])
def test_rerun_of_an_uncommitted_batch(spark, env, keep):
    """The commit of the last batch is lost after its writes: the retry leaves the same store."""
    feed, store, run, checkpoint = env
    values = bodies(2)
    feed.add(values[:200])
    feed.add(values[200:])
    run(keep=keep)
    before = rows(read_days(spark, store))
    commits = sorted(p for p in __import__("pathlib").Path(checkpoint, "commits").iterdir() if p.name.isdigit())
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    seen = run(keep=keep)
    assert [m["batch_id"] for m in seen] == [1]
    assert rows(read_days(spark, store)) == before


def test_batch_that_died_before_its_ledger(spark, env, monkeypatch):
    feed, store, run, _ = env
    values = bodies(3)
    feed.add(values[:200])
    run()
    feed.add(values[200:])
    whole = pipeline.offset_ledger

    def broken(*a):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(pipeline, "offset_ledger", broken)
    with pytest.raises(Exception, match="executor lost"):
        run()
    monkeypatch.setattr(pipeline, "offset_ledger", whole)
    run()
    assert stored(spark, store) == batch_result(spark, values)


def test_new_checkpoint_continues_the_numbers(spark, env, tmp_path):
    feed, store, run, checkpoint = env
    values = bodies(4)
    feed.add(values[:200])
    run()
    feed.add(values[200:])
    other = str(tmp_path / "cp2")
    assert [m["batch_id"] for m in run(cp=other)] == [1, 2]
    assert run(cp=other) == []
    assert stored(spark, store) == batch_result(spark, values)


def test_compaction(spark, env):
    feed, store, run, _ = env
    values = bodies(5)
    for i in range(0, 400, 100):
        feed.add(values[i : i + 100])
    run()
    want = batch_result(spark, values)
    days = sorted({r[DAU_COLUMNS.index("dt")] for r in want})
    for day in days[:2]:
        compact(spark, store, day, grace=0)
        assert len(rows(read_day(spark, store, day).select("batch_id").distinct())) == 1
    assert stored(spark, store) == want
    compact(spark, store, "1999-01-01", grace=0)
    # Late records after compaction, then compaction again.
    more = bodies(6, 100)
    feed.add(more)
    run()
    want = batch_result(spark, values + more)
    assert stored(spark, store) == want
    compact(spark, store, days[0], grace=0)
    assert stored(spark, store) == want


def test_compaction_that_died_half_way(spark, env, monkeypatch):
    feed, store, run, _ = env
    values = bodies(7)
    feed.add(values[:200])
    feed.add(values[200:])
    run()
    want = batch_result(spark, values)
    import firstlight.streaming.upsert as upsert

    def dies(spark, folders):
        assert stored(spark, store) == want
        raise RuntimeError("died")

    with monkeypatch.context() as m:
        m.setattr(upsert.folders, "remove", dies)
        with pytest.raises(RuntimeError):
            compact(spark, store, "2024-01-02", grace=0)
    assert stored(spark, store) == want
    more = bodies(16, 100)
    feed.add(more)
    run()
    compact(spark, store, "2024-01-02", grace=0)
    assert len(rows(read_day(spark, store, "2024-01-02").select("batch_id").distinct())) == 1
    assert stored(spark, store) == batch_result(spark, values + more)


def test_folders_of_an_open_day_stay_few(spark, env):
    feed, store, run, checkpoint = env
    values = [log(f"d{i}", ms("2024-01-01 10:00") + i) for i in range(14)]
    for v in values:
        feed.add([v])
    pipeline.start_pipeline(feed.stream(), store.root, checkpoint, trigger=None, fold_every=4, grace=0).awaitTermination()
    assert read_days(spark, store).select("batch_id").distinct().count() <= 4
    assert stored(spark, store) == batch_result(spark, values)


def test_reading_a_day_lists_only_that_day(spark, env):
    feed, store, run, _ = env
    feed.add(bodies(8))
    run()
    files = read_day(spark, store, "2024-01-02").inputFiles()
    assert files and all("/dt=2024-01-02/" in f or "/dt=none/" in f for f in files)


def test_many_days_in_a_batch(spark, env):
    feed, store, run, _ = env
    values = [log(f"d{i % 7}", ms("2024-01-01 10:00") + i * 86_400_000 // 3) for i in range(60)]
    feed.add(values[30:])
    feed.add(values[:40])
    run()
    assert stored(spark, store) == batch_result(spark, values)


def test_zone_and_minute(spark, env):
    feed, store, run, _ = env
    feed.add([log("a", ms("2024-01-01 20:15"))])
    run(tz="Asia/Shanghai", minute="event")
    assert rows(read_days(spark, store), "dt", "hr", "mi") == [("2024-01-02", "04", "15")]


def test_metrics_read_the_store(spark, env):
    feed, store, run, _ = env
    values = bodies(10)
    feed.add(values[:200])
    feed.add(values[200:])
    run()
    want = batch_result(spark, values)
    total = dict(rows(metrics.dau_total(read_days(spark, store))))
    for day, n in total.items():
        assert n == sum(1 for r in want if r[DAU_COLUMNS.index("dt")] == day)
        hours = rows(metrics.dau_hour(read_day(spark, store, day), day))
        assert sum(r[2] for r in hours) == n
    day = "2024-01-02"
    two = read_days(spark, store, ["2024-01-01", day])
    assert metrics.hourly_compare(two, day).agg(F.sum("today_n")).first()[0] == total[day]
    for d in sorted(total):
        update_first_seen(spark, store, d)
    update_first_seen(spark, store, day)
    seen = read_first_seen(spark, store)
    assert dict(rows(seen.groupBy("dt").count())) == {d: n for d, n in rows(metrics.new_devices(read_days(spark, store)))}
    kpis = rows(metrics.kpi_totals(read_days(spark, store), day), "id", "value")
    assert rows(metrics.kpi_totals(read_day(spark, store, day), day, seen), "id", "value") == kpis


def test_landing_and_routing_streams(spark, env, tmp_path):
    feed, _, _, _ = env
    values = [log("a", 1, start={}), log("b", 2), "broken {"]
    feed.add(values)
    landed, routed = str(tmp_path / "landed"), str(tmp_path / "routed")
    land_raw_stream(feed.stream(), landed, str(tmp_path / "c1"), trigger=None).awaitTermination()
    route_stream_to_files(feed.stream(), routed, str(tmp_path / "c2"), trigger=None).awaitTermination()
    land_raw_stream(feed.stream(), landed, str(tmp_path / "c1"), trigger=None).awaitTermination()
    assert sorted(r[0] for r in spark.read.text(landed).select("value").collect()) == sorted(values)
    back = spark.read.schema("value string, topic string").text(routed)
    assert rows(back, "topic", "value") == [("event_log", values[1]), ("start_log", values[0])]


def record_stream(spark, path):
    schema = ingest.to_dau_info(ingest.parse_logs(spark.createDataFrame([], RAW_LOG))).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def write_records(spark, path, i, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    ingest.to_dau_info(ingest.usable(ingest.parse_logs(df))).coalesce(1).write.parquet(f"{path}/f{i:03d}")


def drain(df, mode, checkpoint):
    """Rows a query emits."""
    got = []
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda b, i: got.extend(tuple(r) for r in b.select(*DAU_COLUMNS).collect()))
    writer.trigger(availableNow=True).start().awaitTermination()
    return got


def test_state_gives_every_device_once_a_day(spark, tmp_path):
    values, path = bodies(12), str(tmp_path / "in")
    for i in range(3):
        write_records(spark, path, i, values[i * 100 : i * 100 + 200])
    got = drain(first_per_day_stream(record_stream(spark, path)), "update", str(tmp_path / "cp"))
    mid, dt = DAU_COLUMNS.index("mid"), DAU_COLUMNS.index("dt")
    want = batch_result(spark, values)
    assert sorted((r[dt], r[mid]) for r in got) == sorted((r[dt], r[mid]) for r in want)


def test_expiry_counts_a_device_again(spark, tmp_path):
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    one = [log("a", ms("2024-01-01 10:00"))]
    stream = lambda: first_per_day_stream(record_stream(spark, path), expire="1 second")
    for i in range(2):
        write_records(spark, path, i, one)
        assert len(drain(stream(), "update", cp)) == 1
        time.sleep(1.5)


def test_no_launch_is_late(spark, tmp_path):
    """Latest days first, and a clock of the year 9999 in the first batch."""
    path, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    wild = [log("w", ms("9999-12-31 23:00"))]
    days = [[log(f"d{i}", ms(f"2024-{m:02d}-{d:02d} 10:00")) for i in range(5)] for m, d in ((3, 20), (2, 2), (1, 1))]
    for i, part in enumerate([wild, *days]):
        write_records(spark, path, i, part)
    versions = drain(earliest_updates(record_stream(spark, path)), "update", cp)
    assert len(versions) == 16 == len({(r[DAU_COLUMNS.index("dt")], r[DAU_COLUMNS.index("mid")]) for r in versions})


def test_batches_are_reduced_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "in")
    write_records(spark, path, 0, bodies(13))
    query = earliest_updates(record_stream(spark, path)).writeStream.outputMode("update").foreachBatch(lambda b, i: b.count())
    query = query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.index("Exchange hashpartitioning") < plan.rindex("partial_min_by")


def test_earliest_updates_emit_new_and_improved_only(spark, tmp_path):
    values, path = bodies(13), str(tmp_path / "in")
    parts = [values[200:], values[:200], values[100:300]]
    for i, p in enumerate(parts):
        write_records(spark, path, i, p)
    got = drain(earliest_updates(record_stream(spark, path)), "update", str(tmp_path / "cp"))
    versions = spark.createDataFrame(got, ",".join(f"{c} {'long' if c == 'ts' else 'string'}" for c in DAU_COLUMNS))
    want = batch_result(spark, values)
    assert rows(first_per_day(versions), *DAU_COLUMNS) == want
    assert len(got) == len(set(got)) and len(got) < len(want) * 2


def test_state_pipeline_equals_batch(spark, env, tmp_path):
    feed, store, _, checkpoint = env
    values = bodies(15)

    def run():
        pipeline.start_state_pipeline(feed.stream(), store.root, checkpoint, trigger=None).awaitTermination()

    feed.add(values[200:] + ["broken {"])
    feed.add(values[100:200])
    run()
    feed.add(values[:150])
    run()
    assert stored(spark, store) == batch_result(spark, values)
    old = [log("z", ms("2023-12-01 05:00"))]
    feed.add(old)
    run()
    assert stored(spark, store) == batch_result(spark, values + old)
    quarantine_stream(feed.stream(), str(tmp_path / "bad"), str(tmp_path / "cq"), trigger=None).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "bad"))) == [("broken {", "bad_json")]


def test_upsert_without_named_days(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    values = bodies(14)
    df = spark.createDataFrame([(v,) for v in values], "value string")
    recs = ingest.to_dau_info(ingest.usable(ingest.parse_logs(df)))
    upsert_by_key(recs, 0, store)
    upsert_by_key(recs, 1, store)
    want = batch_result(spark, values)
    assert stored(spark, store) == want
    assert batch_metrics(spark, store, 0).agg(F.sum("written")).first()[0] == len(want)
    assert batch_metrics(spark, store, 1).count() == 0
