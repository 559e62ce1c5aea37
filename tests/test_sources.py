import json

import pytest
from helpers import log, raw, rows

from firstlight.operators import ledger
from firstlight.session import scratch_dir
from firstlight.sources.logs import (
    kafka_sink_options,
    kafka_source_options,
    read_file_log_stream,
    starting_offsets,
)
from firstlight.sources.store import StorePaths, get_by_id


def test_kafka_options_are_new_each_time():
    a = kafka_source_options("h:9092", "t", group="g1", offsets={1: 7, 0: 5})
    b = kafka_source_options("h:9092", "t")
    assert a["kafka.group.id"] == "g1" and json.loads(a["startingOffsets"]) == {"t": {"0": 5, "1": 7}}
    assert "kafka.group.id" not in b and b["startingOffsets"] == "latest"
    assert kafka_source_options("h", "t", max_per_trigger=5, min_partitions=9)["maxOffsetsPerTrigger"] == "5"
    assert json.loads(starting_offsets("t", {1: 7}, range(3))) == {"t": {"0": -2, "1": 7, "2": -2}}
    assert kafka_sink_options("h:9092") == {"kafka.bootstrap.servers": "h:9092"}


def test_ledger_and_start_position(spark, tmp_path):
    store = StorePaths(str(tmp_path))
    assert ledger.resolve_start(ledger.read_ledger(spark, store), "start_log") == "latest"
    batches = raw(spark, [log(ts=i) for i in range(7)])
    first, second = batches.filter("offset < 4"), batches.filter("offset >= 4")
    assert rows(ledger.offset_ledger(first, 3)) == [(3, "start_log", 0, 0, 3), (3, "start_log", 1, 1, 4)]
    for i, part in enumerate((first, second)):
        out = ledger.offset_ledger(part, i).drop("batch_id")
        out.write.parquet(f"{store.ledger}/batch_id={i}")
    stored = ledger.read_ledger(spark, store)
    assert rows(ledger.next_offsets(stored, "start_log")) == [(0, 7), (1, 6)]
    assert json.loads(ledger.resolve_start(stored, "start_log")) == {"start_log": {"0": 7, "1": 6}}
    assert ledger.resolve_start(stored, "other") == starting_offsets("other", None) == "latest"


def test_point_lookup_reaches_the_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    found = get_by_id(spark.read.parquet(str(tmp_path / "t")), "id", 42)
    assert rows(found) == [(42,)]
    assert "EqualTo(id,42)" in found._jdf.queryExecution().executedPlan().toString()


class FakeSession:
    """Settings of a session that is not running here."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_dir_is_shared_or_refused(spark):
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert scratch_dir(spark, "a").startswith(shared)
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_dir(FakeSession(spark_master=master, spark_sql_warehouse_dir="file:/tmp/warehouse"), "a")


def test_file_stream_shape(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = read_file_log_stream(spark, str(tmp_path / "in"))
    assert stream.columns == ["value", "topic", "partition", "offset"]
    assert read_file_log_stream(spark, str(tmp_path / "in"), fmt="parquet").columns == stream.columns
