"""Reading tables, writing intermediate ones, files in the shared folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.session import scratch_dir

# Shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows that a task hands to Python at once: a batch of texts, sets or prefixes stands in memory several times on both sides.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1 << 11
# Bits that tasks hold of the keys that rows are screened by, and those of one bitmap of Spark.
SCREEN_BITS = 1 << 26
BITMAP_BITS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Inside, queries hand at most ``rows`` rows to Python at once."""
    before = spark.conf.get(BATCH)
    if not 0 < int(before) <= rows:
        spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a new folder and read again: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        with small_batches(spark):
            df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*tables: DataFrame | None) -> None:
    """Removes the folders of tables that ``stored`` made; nothing may read them any more."""
    for df in tables:
        if df is not None:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def screened(rows: DataFrame, key: list[Column], wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is in no row of ``wanted``, and all others, some of which have none there either.

    ``wanted`` has the columns of the key only, of the same types. Tasks hold
    one bit for each place of the keys' hashes, SCREEN_BITS at any table size,
    so the first rows need no shuffle; an exact test of the others follows.
    """
    place = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(SCREEN_BITS))
    block, bits = free_name(rows, "screen_block"), free_name(rows, "screen_bits")
    at = place(wanted.columns)
    places = wanted.select(F.floor(at / BITMAP_BITS).alias(block), (at % BITMAP_BITS).alias("bit")).distinct()
    bitmaps = stored(places.groupBy(block).agg(F.bitmap_construct_agg("bit").alias(bits)), "screen")
    at = place(key)
    met = rows.withColumn(block, F.floor(at / BITMAP_BITS)).join(F.broadcast(bitmaps), block, "left")
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at % BITMAP_BITS / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return met.filter(~hit).drop(block, bits), met.filter(hit).drop(block, bits)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or with as many underscores in front as make it none of the frame's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filesystem(path: str):
    """An Arrow filesystem and the path in it, for a path or URI as Hadoop writes it."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)
