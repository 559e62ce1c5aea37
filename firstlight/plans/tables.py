"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firstlight.functions.clock import epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def launches(ev: DataFrame) -> DataFrame:
    """Every event as one launch: ``dt DATE, mid, hr INT``.

    A comparison of ``dt`` with a day becomes a range on ``ts`` in the Parquet
    scan.
    """
    return ev.select(
        F.col("ts").cast("date").alias("dt"),
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.hour("ts").alias("hr"),
    )


def logs(ev: DataFrame, areas: bool = False) -> DataFrame:
    """Every event as one device launch: ``mid, uid, ch, vc, ts``; ``user_id`` is kept for :func:`with_area`."""
    return ev.select(
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("ch"),
        F.concat(F.lit("v"), F.get_json_object("props", "$.k")).alias("vc"),
        epoch_ms("ts").alias("ts"),
        "user_id",
    )


def with_area(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add ``ar``, the nation of the user.  Used after deduplication, on one row per device and day."""
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ar"))
    # The small tables meet first, so the large one is joined once.
    named = users.join(nations, "c_nationkey", "left").select("user_id", "ar")
    return df.join(named, "user_id", "left").drop("user_id")


def raw_logs(ev: DataFrame, body: Column | None = None) -> DataFrame:
    """Events as raw log records; a ``signup`` carries a start object."""
    common = F.struct(
        F.concat(F.lit("mid_"), F.col("user_id")).alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("ch"),
        F.concat(F.lit("v"), F.get_json_object("props", "$.k")).alias("vc"),
    )
    start = F.when(F.col("event_type") == "signup", F.struct(F.col("value").alias("loading")))
    log = F.to_json(F.struct(common.alias("common"), start.alias("start"), epoch_ms("ts").alias("ts")))
    return ev.select(
        log.alias("value"),
        F.lit("app_log").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("date").cast("string").alias("ingest_date"),
        "event_type",
    )


def order_detail(spark: SparkSession, sf_dir: str, date: str | None = None) -> DataFrame:
    """Order lines; the day is a range on the order time so that it reaches the Parquet scan."""
    orders = table(spark, sf_dir, "orders")
    if date is not None:
        day = F.to_date(F.lit(date))
        orders = orders.filter(
            (F.col("o_orderdate") >= day.cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.date_add(day, 1).cast("timestamp_ntz"))
        )
    lines = table(spark, sf_dir, "lineitem")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_detail_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("sku_id"),
        F.try_divide("l_extendedprice", "l_quantity").alias("sku_price"),
        F.col("o_orderdate").cast("date").cast("string").alias("dt"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users; gender, age and level are stand-ins made from the key."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("user_id"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("user_gender"),
        (10 + key % 50).cast("int").alias("user_age"),
        (1 + key % 10).cast("int").alias("user_level"),
        F.col("c_nationkey").alias("region_id"),
    )


def skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("sku_tm_id"),
        F.col("p_type").alias("category"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("name"))


def units_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_id, units, n``: summed per order before any join, so a hot order stays one row."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,4)")).alias("units"), F.count("*").alias("n"))
    )


def order_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"))


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents with an array of two objects: brand and type."""
    p = table(spark, sf_dir, "part")
    entry = lambda i, n: F.struct(F.lit(i).cast("long").alias("id"), F.col(n).alias("name"))
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("float").alias("doubanScore"),
        F.array(entry(1, "p_brand"), entry(2, "p_type")).alias("actorList"),
    )
