"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# AQE sizes post-shuffle partitions and splits skewed joins at run time;
# dynamic overwrite replaces only the partitions a batch writes; the RocksDB
# provider keeps streaming state off the JVM heap.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "firstlight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_settings(cores: int, input_bytes: int) -> dict[str, str]:
    """Partition counts and sizes for a cluster of ``cores`` reading ``input_bytes``.

    Shuffles start with partitions of about 128 MB of the input (three per
    core at least) and AQE joins the small ones; scans read 256 MB at a time.
    Streaming state keeps the partition count of its first start, so start a
    stateful stream with the count it needs.
    """
    partitions = max(3 * cores, -(-input_bytes // (128 * 2**20)))
    return {
        "spark.sql.shuffle.partitions": str(3 * cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under ``spark.checkpoint.dir``, removed when the session's JVM ends.

    With the setting unset the session's warehouse folder is used, which a
    cluster must share as well: a machine-local warehouse is refused there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        local_path = shared.startswith("/") or shared.startswith("file:")
        master = spark.conf.get("spark.master", "")
        if local_path and not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        shared = f"{shared.rstrip('/')}/_scratch"
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
