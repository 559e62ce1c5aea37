"""Fixed schemas of the log, the activity record and the result tables."""

from pyspark.sql import types as T

# Only the fields that are read.  ``start`` keeps its raw JSON because only its
# presence matters, and ``ts`` arrives as text so that "1627604275000" and
# 1627604275000 are both accepted and anything else can be told apart.
LOG_SCHEMA = T.StructType(
    [
        T.StructField(
            "common",
            T.StructType([T.StructField(n, T.StringType()) for n in ("mid", "uid", "ar", "ch", "vc")]),
        ),
        T.StructField("start", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)

ROUTE_SCHEMA = T.StructType(
    [T.StructField("start", T.StringType()), T.StructField("_corrupt", T.StringType())]
)

# What a log source yields, whatever the transport.
RAW_LOG = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# mid device, uid user, ar area, ch channel, vc version, dt day, hr hour,
# mi minute, ts epoch milliseconds.
DAU_INFO = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi")]
    + [T.StructField("ts", T.LongType())]
)
DAU_COLUMNS = DAU_INFO.fieldNames()

# The stored form: one version of a record per micro-batch that wrote it.
DAU_STORE = T.StructType(
    [f for f in DAU_INFO.fields if f.name != "dt"]
    + [T.StructField("dt", T.StringType()), T.StructField("batch_id", T.LongType())]
)

OFFSET_LEDGER = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("from_offset", T.LongType()),
        T.StructField("until_offset", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("checkpoint", T.StringType()),
        T.StructField("batch_base", T.LongType()),
    ]
)

# Devices by the hour of their first launch, as increments.
HOUR_SUMS = T.StructType(
    [T.StructField("dt", T.StringType()), T.StructField("hr", T.StringType()), T.StructField("n", T.LongType())]
)
DAY_SUMS = T.StructType([T.StructField("dt", T.StringType()), T.StructField("n", T.LongType())])

# What each micro-batch read, rejected and wrote; ``added`` counts devices new to their day.
BATCHES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("logs", "rejected", "written", "added", "days", "batch_id")]
)

# Bodies as text in the sinks of the one-pass ingest.
INGESTED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("value", "sink", "part")] + [T.StructField("batch_id", T.LongType())]
)

# A finished micro-batch as its listener saw it; times in milliseconds.
BATCH_TIMES = T.StructType(
    [T.StructField("query", T.StringType()), T.StructField("started", T.TimestampType())]
    + [T.StructField(n, T.LongType()) for n in ("batch_id", "rows", "trigger_ms", "write_ms")]
)

# Launches per hour as the windows of arrival count them.
LAUNCH_HOURS = T.StructType(
    [T.StructField("arrival", T.TimestampType()), T.StructField("dt", T.StringType()), T.StructField("hr", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("n", "batch_id")]
)

# When a day's set of seen devices began, and the batch that began it.
EPOCHS = T.StructType(
    [T.StructField("dt", T.StringType()), T.StructField("started", T.TimestampType()), T.StructField("epoch", T.LongType())]
)
SEEN = T.StructType([T.StructField("mid", T.StringType()), T.StructField("dt", T.StringType()), T.StructField("epoch", T.LongType()), T.StructField("batch_id", T.LongType())])

FIRST_SEEN = T.StructType([T.StructField("mid", T.StringType()), T.StructField("dt", T.StringType())])
DEVICE_DAYS = T.StructType([*FIRST_SEEN.fields, T.StructField("batch_id", T.LongType())])

# A document with an array of objects, for the nested search.
NESTED_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("doubanScore", T.FloatType()),
        T.StructField(
            "actorList",
            T.ArrayType(
                T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
            ),
        ),
    ]
)

SALE_DETAIL_COLUMNS = [
    "order_detail_id",
    "order_id",
    "user_id",
    "sku_id",
    "user_gender",
    "user_age",
    "user_level",
    "sku_price",
    "sku_name",
    "sku_tm_id",
    "dt",
]
