"""Every registered query next to the SQL that gives the same rows."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firstlight.functions import labels
from firstlight.functions.clock import today_text
from firstlight.functions.labels import AGE_20_TO_30, AGE_OVER_30, AGE_UNDER_20, DEFAULT_SALE_DATE, GENDER_NAMES, KPI_NAMES
from firstlight.functions.predicates import term_in_array
from firstlight.functions.text import match_text
from firstlight.operators import dedup, ingest, ledger, metrics, sale
from firstlight.operators.documents import live_folders, merge_documents, read_documents, upsert_documents
from firstlight.operators.pages import ranged_page, read_ranged, write_ranged
from firstlight.operators.search import search, search_after
from firstlight.plans import dashboard, tables
from firstlight.session import scratch_dir
from firstlight.sources.logs import read_file_log_stream
from firstlight.sources.store import StorePaths, get_by_id, get_device, read_day, read_days
from firstlight.streaming.first_seen import merge_first_seen, read_first_seen, read_new_devices, rebuild_first_seen
from firstlight.streaming.launches import read_hourly, start_hourly_counts
from firstlight.streaming.pipeline import ARRIVED, process_batch, read_batches, start_pipeline
from firstlight.streaming.sinks import ingest_batch, read_ingested
from firstlight.streaming.state import first_per_day_stream
from firstlight.streaming.upsert import compact, current, read_hours, upsert_by_key

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-02"
SALE_DAY = "1998-10-03"
FIRST_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Every event as a launch.
LAUNCHES = """
l AS (
  SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, 'mid_' || user_id AS mid FROM events
)"""
FIRST_HOURS = LAUNCHES + """,
f AS (SELECT dt, mid, min(hr) AS hr FROM l GROUP BY dt, mid)"""
RECORDS = """
r AS (
  SELECT 'mid_' || e.user_id AS mid, CAST(e.user_id AS VARCHAR) AS uid, n.n_name AS ar, e.event_type AS ch,
         'v' || json_extract_string(e.props, '$.k') AS vc,
         strftime(e.ts, '%Y-%m-%d') AS dt, strftime(e.ts, '%H') AS hr, '00' AS mi, epoch_us(e.ts) // 1000 AS ts,
         e.event_id
  FROM events e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""
FIRSTS = f"""
WITH {RECORDS}
SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts FROM r
QUALIFY row_number() OVER (
  PARTITION BY dt, mid
  ORDER BY ts, uid NULLS FIRST, ch NULLS FIRST, vc NULLS FIRST, ar NULLS FIRST) = 1
"""
SALES = """
s AS (
  SELECT l.l_orderkey || '-' || l.l_linenumber AS order_detail_id, CAST(o.o_orderkey AS VARCHAR) AS order_id,
         CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS sku_id,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'M' WHEN c.c_custkey % 2 = 1 THEN 'F' END AS user_gender,
         CAST(10 + c.c_custkey % 50 AS INTEGER) AS user_age, CAST(1 + c.c_custkey % 10 AS INTEGER) AS user_level,
         l.l_extendedprice / nullif(l.l_quantity, 0) AS sku_price, p.p_name AS sku_name, p.p_brand AS sku_tm_id,
         strftime(o.o_orderdate, '%Y-%m-%d') AS dt
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
)"""


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql.strip()
        return f

    return register


def _launches(spark: SparkSession, d: str) -> DataFrame:
    return tables.launches(tables.events(spark, d))


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return tables.raw_logs(tables.events(spark, d))


def _with_area(df: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    keyed = df.drop("ar").withColumn("user_id", F.col("uid").cast("long"))
    return tables.with_area(keyed, spark, d).select(*FIRST_COLUMNS)


# ---------------------------------------------------------------- ingest


@query(
    "parse_start_log",
    f"WITH {RECORDS} SELECT mid, uid, ar, ch, vc, dt, hr, mi, ts, ch = 'signup' AS has_start FROM r",
)
def parse_start_log(spark, d):
    parsed = ingest.usable(ingest.parse_logs(_raw(spark, d).select("value")))
    records = ingest.with_dt_hr(parsed).withColumn("mi", F.lit("00"))
    keyed = records.drop("ar").withColumn("user_id", F.col("uid").cast("long"))
    return tables.with_area(keyed, spark, d).select(*FIRST_COLUMNS, "has_start")


def _damaged(spark, d):
    """Errors lose their last character, purchases their stamp, clicks their device."""
    kind, value = F.col("event_type"), F.col("value")
    damaged = (
        F.when(kind == "error", F.expr("substr(value, 1, length(value) - 1)"))
        .when(kind == "purchase", F.regexp_replace(value, '"ts":', '"at":'))
        .when(kind == "click", F.regexp_replace(value, '"mid":', '"id":'))
        .otherwise(value)
    )
    return _raw(spark, d).withColumn("value", damaged)


@query(
    "quarantine_reasons",
    """
    SELECT CASE event_type WHEN 'error' THEN 'bad_json' WHEN 'purchase' THEN 'no_ts' ELSE 'no_mid' END AS reason,
           strftime(ts, '%Y-%m-%d') AS ingest_date, count(*) AS n
    FROM events WHERE event_type IN ('error', 'purchase', 'click') GROUP BY ALL
    """,
)
def quarantine_reasons(spark, d):
    parsed = ingest.parse_logs(_damaged(spark, d))
    bad = parsed.filter(F.col("reason").isNotNull())
    return bad.groupBy("reason", "ingest_date").agg(F.count("*").alias("n"))


@query(
    "route_logs",
    """
    SELECT CASE WHEN event_type = 'signup' THEN 'start_log' ELSE 'event_log' END AS topic, count(*) AS n
    FROM events GROUP BY 1
    """,
)
def route_logs(spark, d):
    return ingest.route_logs(_raw(spark, d)).groupBy("topic").agg(F.count("*").alias("n"))


@query(
    "routed_topics",
    """
    SELECT CASE WHEN event_type = 'signup' THEN 'start_log' ELSE 'event_log' END AS topic, event_type AS ch,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def routed_topics(spark, d):
    """Written to one folder per topic and read back."""
    path = scratch_dir(spark, "routed")
    ingest.write_routed(ingest.route_logs(_raw(spark, d)), path)
    back = spark.read.schema("value string, topic string").text(path)
    return back.groupBy("topic", F.get_json_object("value", "$.common.ch").alias("ch")).agg(F.count("*").alias("n"))


@query(
    "raw_landing_daily",
    "SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, count(*) AS n FROM events GROUP BY 1",
)
def raw_landing_daily(spark, d):
    path = scratch_dir(spark, "landing")
    ingest.land_raw(_raw(spark, d), path)
    landed = spark.read.schema("value string, ingest_date string").text(path)
    return landed.groupBy("ingest_date").agg(F.count("*").alias("n"))


@query(
    "ingest_one_pass",
    """
    WITH e AS (
      SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'signup' THEN 'start_log' WHEN event_type <> 'error' THEN 'event_log' END AS topic,
             CASE event_type WHEN 'error' THEN 'bad_json' WHEN 'purchase' THEN 'no_ts' WHEN 'click' THEN 'no_mid' END AS reason
      FROM events)
    SELECT 'raw' AS sink, day AS part, count(*) AS n FROM e GROUP BY day
    UNION ALL SELECT 'topics', topic, count(*) FROM e WHERE topic IS NOT NULL GROUP BY topic
    UNION ALL SELECT 'rejected', reason, count(*) FROM e WHERE reason IS NOT NULL GROUP BY reason
    """,
)
def ingest_one_pass(spark, d):
    """Landing, topics and quarantine of the damaged logs, written by one job with one parse."""
    root = scratch_dir(spark, "ingested")
    ingest_batch(_damaged(spark, d), 0, root)
    return read_ingested(spark, root).groupBy("sink", "part").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- first launches


def _firsts(spark, d):
    records = ingest.with_dt_hr(tables.logs(tables.events(spark, d))).withColumn("mi", F.lit("00"))
    # The area depends on the user alone, so it cannot change which row is first.
    return dedup.first_per_day(records, order=[c for c in dedup.LAUNCH_ORDER if c != "ar"])


@query("first_per_day", FIRSTS)
def first_per_day(spark, d):
    return tables.with_area(_firsts(spark, d), spark, d).select(*FIRST_COLUMNS)


@query("first_per_day_stream", FIRSTS)
def first_per_day_stream_query(spark, d):
    """Raw logs through the pipeline in two runs of one checkpoint: launch logs, then all other logs.

    Most devices of a day come in both runs, and the earlier launch is often
    in the second.
    """
    landing, root, checkpoint = (scratch_dir(spark, n) for n in ("landing", "store", "checkpoint"))
    routed = ingest.route_logs(_raw(spark, d))
    for topic in (ingest.START_TOPIC, ingest.EVENT_TOPIC):
        ingest.write_routed(routed.filter(F.col("topic") == topic), landing)
        logs = read_file_log_stream(spark, landing, max_bytes=200 * 2**30)
        start_pipeline(logs, root, checkpoint, trigger=None).awaitTermination()
    return _with_area(current(read_days(spark, StorePaths(root))), spark, d)


LAST_DAY = "(SELECT strftime(max(ts), '%Y-%m-%d') FROM events)"


def _store(spark, d) -> tuple[StorePaths, str]:
    """A store filled by two batches, launch logs and all other logs, and its last day."""
    store, routed = StorePaths(scratch_dir(spark, "store")), ingest.route_logs(_raw(spark, d))
    whole = lambda topic: routed.filter(F.col("topic") == topic).select(
        "value", "topic", F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset")
    )
    for i, topic in enumerate((ingest.START_TOPIC, ingest.EVENT_TOPIC)):
        process_batch(whole(topic), i, store)
    return store, tables.events(spark, d).select(F.max("ts").cast("date").cast("string")).first()[0]


@query("compacted_day", f"SELECT * FROM ({FIRSTS}) WHERE dt = {LAST_DAY}")
def compacted_day(spark, d):
    """One day of the store after its two batches were folded."""
    store, day = _store(spark, d)
    compact(spark, store, day)
    return _with_area(current(read_day(spark, store, day)), spark, d)


@query("store_day_total", f"WITH {LAUNCHES} SELECT dt, count(DISTINCT mid) AS n FROM l WHERE dt = {LAST_DAY} GROUP BY dt")
def store_day_total(spark, d):
    """One day's devices; only that day's folder is listed."""
    store, day = _store(spark, d)
    return metrics.dau_total(read_day(spark, store, day), day)


@query(
    "kpi_totals_first_seen",
    f"""
    WITH {LAUNCHES}, first_seen AS (SELECT mid, min(dt) AS dt FROM l GROUP BY mid)
    SELECT 'dau' AS id, '{KPI_NAMES["dau"]}' AS name, count(DISTINCT mid) AS value FROM l WHERE dt = {LAST_DAY}
    UNION ALL
    SELECT 'new_mid', '{KPI_NAMES["new_mid"]}', count(*) FROM first_seen WHERE dt = {LAST_DAY}
    """,
)
def kpi_totals_first_seen(spark, d):
    """The day's two figures from its folder and the first-seen table."""
    store, day = _store(spark, d)
    rebuild_first_seen(spark, store)
    return metrics.kpi_totals(read_day(spark, store, day), day, read_first_seen(spark, store))


@query("dau_total_stream", f"WITH {LAUNCHES} SELECT dt, count(DISTINCT mid) AS n FROM l GROUP BY dt")
def dau_total_stream(spark, d):
    """The low-latency form: first arrivals from streaming state; half of the files a trigger, latest days first."""
    landing, out, checkpoint = (scratch_dir(spark, n) for n in ("landing", "arrivals", "checkpoint"))
    events = tables.events(spark, d)
    middle = events.select(F.to_date(F.min("ts") + (F.max("ts") - F.min("ts")) / 2)).first()[0]
    late = F.coalesce(F.to_date("ts") > F.lit(middle), F.lit(False))
    for part in (late, ~late):
        events.filter(part).write.mode("append").parquet(landing)
    # Half of the files each: two triggers, however many files there are.
    n_files = len(spark.read.schema(events.schema).parquet(landing).inputFiles())
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", max(1, -(-n_files // 2))).parquet(landing)
    records = ingest.with_dt_hr(tables.logs(source)).withColumns(
        {"ar": F.lit(None).cast("string"), "mi": F.lit("00")}
    )
    arrivals = first_per_day_stream(records.select(*FIRST_COLUMNS))

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = arrivals.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    # A run over the end of a window emits a device twice.
    return spark.read.parquet(out).groupBy("dt").agg(F.count_distinct("mid").alias("n"))


def _records(spark, d) -> DataFrame:
    records = ingest.with_dt_hr(tables.logs(tables.events(spark, d)))
    return records.withColumns({"ar": F.lit(None).cast("string"), "mi": F.lit("00")}).select(*FIRST_COLUMNS)


@query("dau_hour_incremental", f"WITH {FIRST_HOURS} SELECT dt, hr, count(*) AS n FROM f GROUP BY dt, hr")
def dau_hour_incremental(spark, d):
    """Three batches, evenings first, then nights, then the day: most devices change their hour twice.

    Read from the increments of the batches; no record is read.
    """
    store, records, hr = StorePaths(scratch_dir(spark, "store")), _records(spark, d), F.col("hr")
    for i, part in enumerate((hr >= "16", hr < "08", (hr >= "08") & (hr < "16"))):
        upsert_by_key(records.filter(part), i, store)
    return read_hours(spark, store)


@query(
    "new_devices_incremental",
    f"WITH {LAUNCHES} SELECT dt, count(*) AS n FROM (SELECT mid, min(dt) AS dt FROM l GROUP BY mid) GROUP BY dt",
)
def new_devices_incremental(spark, d):
    """Three batches, the latest days first: nearly every device is corrected to an earlier day."""
    store, days = StorePaths(scratch_dir(spark, "store")), _records(spark, d).select("mid", "dt")
    third = lambda k: F.ntile(3).over(Window.orderBy(F.desc("dt"))) == k
    parts = days.select("dt").distinct().withColumn("last", third(1)).withColumn("middle", third(2))
    named = days.join(F.broadcast(parts), "dt").withColumn("batch", F.when(F.col("last"), 0).when(F.col("middle"), 1).otherwise(2))
    for i in range(3):
        merge_first_seen(named.filter(F.col("batch") == i).select("mid", "dt"), i, store, buckets=8)
    return read_new_devices(spark, store)


@query(
    "batch_written",
    f"""
    WITH {RECORDS},
    f AS (SELECT dt, mid, CASE WHEN ch = 'signup' THEN 0 ELSE 1 END AS b, min(row(ts, ch, coalesce(vc, ''))) AS at FROM r GROUP BY ALL),
    w AS (
      SELECT f.b, f.dt, f.mid, s.at IS NULL AS added FROM f LEFT JOIN f s ON f.b = 1 AND s.b = 0 AND s.dt = f.dt AND s.mid = f.mid
      WHERE s.at IS NULL OR f.at < s.at)
    SELECT CAST(b AS BIGINT) AS batch_id, (SELECT count(*) FROM r WHERE (ch <> 'signup') = (b = 1)) AS logs, CAST(0 AS BIGINT) AS rejected,
           count(*) AS written, count(*) FILTER (WHERE added) AS added, count(DISTINCT dt) AS days
    FROM w GROUP BY b
    """,
)
def batch_written(spark, d):
    """What two batches counted while they wrote, launch logs and all others."""
    store, _ = _store(spark, d)
    return read_batches(spark, store).select("batch_id", "logs", "rejected", "written", "added", "days")


@query(
    "arrivals_with_expiry",
    f"""
    WITH {RECORDS},
    x AS (SELECT DISTINCT dt, mid, event_id % 3 AS b FROM r),
    b0 AS (SELECT dt, mid FROM x WHERE b = 0 AND CAST(substr(dt, 9) AS INTEGER) % 2 = 0),
    b1 AS (SELECT dt, mid FROM x WHERE b = 1 AND (dt, mid) NOT IN (SELECT (dt, mid) FROM b0)),
    b2 AS (SELECT dt, mid FROM x WHERE b = 2 AND (dt IN (SELECT dt FROM b0) OR (dt, mid) NOT IN (SELECT (dt, mid) FROM b1)))
    SELECT CAST(0 AS BIGINT) AS batch_id, dt, count(*) AS n FROM b0 GROUP BY dt
    UNION ALL SELECT 1, dt, count(*) FROM b1 GROUP BY dt
    UNION ALL SELECT 2, dt, count(*) FROM b2 GROUP BY dt
    """,
)
def arrivals_with_expiry(spark, d):
    """Three batches, ten and then fifteen hours apart.

    Days with an even number begin their set with the first batch, so it is
    over when the last one comes and all devices count again; the other days'
    sets began with the second batch and are still open.
    """
    store, raw = StorePaths(scratch_dir(spark, "store")), _raw(spark, d)
    third = F.col("offset") % 3
    even = F.day(F.to_date("ingest_date")) % 2 == 0
    for i, (part, hours) in enumerate((((third == 0) & even, 0), (third == 1, 10), (third == 2, 25))):
        arrived = F.expr(f"TIMESTAMP'2024-06-01 08:00:00' + INTERVAL {hours} HOURS")
        logs = raw.filter(part).select("value", "topic", "partition", "offset", arrived.alias(ARRIVED))
        process_batch(logs, i, store, keep="arrival", expire="24 hours")
    return read_days(spark, store).groupBy("batch_id", "dt").agg(F.count("*").alias("n"))


@query(
    "get_device_day",
    f"SELECT * FROM ({FIRSTS}) WHERE dt = {LAST_DAY} AND mid = (SELECT max('mid_' || user_id) FROM events WHERE strftime(ts, '%Y-%m-%d') = {LAST_DAY})",
)
def get_device_day(spark, d):
    """One device of the store's last day, by its key, from the folded day."""
    store, day = _store(spark, d)
    compact(spark, store, day, grace=0)
    mid = read_day(spark, store, day).agg(F.max("mid")).first()[0]
    return _with_area(current(get_device(spark, store, day, mid)), spark, d)


@query(
    "launches_hourly_stream",
    f"WITH {LAUNCHES} SELECT dt, hr, count(*) AS n FROM l GROUP BY dt, hr",
)
def launches_hourly_stream(spark, d):
    """Launches per hour of a stream whose launches land in three parts, days out of order; each part is one trigger."""
    landing, out, checkpoint = (scratch_dir(spark, n) for n in ("landing", "hourly", "checkpoint"))
    logs = tables.logs(tables.events(spark, d)).select("ts", F.abs(F.hash("mid") % 3).alias("file"))
    for k in (2, 0, 1):
        # The stream takes what landed since its last start, as many files as there are.
        logs.filter(F.col("file") == k).select("ts").write.mode("append").parquet(landing)
        start_hourly_counts(spark.readStream.schema("ts long").parquet(landing), out, checkpoint, trigger=None).awaitTermination()
    return read_hourly(spark, out)


@query(
    "new_to_day_incremental",
    f"""
    WITH {LAUNCHES}, seen AS (SELECT DISTINCT dt, mid FROM l WHERE hr < '12')
    SELECT dt, mid, min(hr) AS hr FROM l
    WHERE hr >= '12' AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.dt = l.dt AND seen.mid = l.mid)
    GROUP BY dt, mid
    """,
)
def new_to_day_incremental(spark, d):
    """Two batches per day, before and after noon: devices the second one adds."""
    records = ingest.with_dt_hr(tables.logs(tables.events(spark, d)))
    morning, later = records.filter("hr < '12'"), records.filter("hr >= '12'")
    firsts = dedup.first_per_day(later, order=["ts", "ch", "vc"])
    return dedup.new_to_day(firsts, morning).select("dt", "mid", "hr")


@query(
    "latest_by_key",
    """
    SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1
    """,
)
def latest_by_key(spark, d):
    last = dedup.latest_by_key(tables.events(spark, d).drop("props"), ["user_id"], ["ts", "event_id"])
    return last.select("user_id", "event_id", tables.epoch_ms("ts").alias("ts"), "event_type", "value")


@query("get_by_id", "SELECT event_id, user_id, event_type, value FROM events WHERE event_id = 42")
def get_by_id_query(spark, d):
    return get_by_id(tables.events(spark, d), "event_id", 42).select("event_id", "user_id", "event_type", "value")


@query(
    "offset_ledger",
    """
    SELECT CAST(7 AS BIGINT) AS batch_id, 'app_log' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition",
           min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
    FROM events GROUP BY event_id % 4
    """,
)
def offset_ledger(spark, d):
    return ledger.offset_ledger(_raw(spark, d), 7)


@query(
    "next_offsets",
    'SELECT CAST(event_id % 4 AS INTEGER) AS "partition", max(event_id) + 1 AS "offset" FROM events GROUP BY event_id % 4',
)
def next_offsets(spark, d):
    """Two batches in the ledger: signups, then the rest."""
    raw, started = _raw(spark, d), F.col("event_type") == "signup"
    both = ledger.offset_ledger(raw.filter(started), 0).unionByName(ledger.offset_ledger(raw.filter(~started), 1))
    return ledger.next_offsets(both, "app_log")


# ---------------------------------------------------------------- daily actives


@query("dau_total", f"WITH {LAUNCHES} SELECT dt, count(DISTINCT mid) AS n FROM l GROUP BY dt")
def dau_total(spark, d):
    return metrics.dau_total(_launches(spark, d))


@query("dau_hour", f"WITH {FIRST_HOURS} SELECT dt, hr, count(*) AS n FROM f GROUP BY dt, hr")
def dau_hour(spark, d):
    return metrics.dau_hour(_launches(spark, d))


@query(
    "hour_spine",
    f"""
    WITH {FIRST_HOURS}, h AS (SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hr FROM range(24) t(i))
    SELECT days.dt, h.hr, count(f.mid) AS n
    FROM (SELECT DISTINCT dt FROM f) days CROSS JOIN h LEFT JOIN f ON f.dt = days.dt AND f.hr = h.hr
    GROUP BY days.dt, h.hr
    """,
)
def hour_spine(spark, d):
    return metrics.hour_spine(metrics.dau_hour(_launches(spark, d)), ["n"], by=["dt"])


@query(
    "terms_agg_top",
    f"WITH {FIRST_HOURS} SELECT hr, count(*) AS n FROM f GROUP BY hr ORDER BY n DESC, hr LIMIT 24",
)
def terms_agg_top(spark, d):
    firsts = metrics.dau_hour(_launches(spark, d))
    by_hour = firsts.groupBy("hr").agg(F.sum("n").alias("n"))
    return by_hour.orderBy(F.desc("n"), "hr").limit(24)


@query(
    "terms_agg_channels",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3",
)
def terms_agg_channels(spark, d):
    return metrics.terms_agg(tables.events(spark, d), "event_type", 3)


@query(
    "hourly_compare",
    f"""
    WITH {FIRST_HOURS}, h AS (SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hr FROM range(24) t(i))
    SELECT h.hr, count(f.mid) FILTER (WHERE f.dt = '{DAY}') AS today_n,
           count(f.mid) FILTER (WHERE f.dt = CAST(DATE '{DAY}' - 1 AS VARCHAR)) AS yesterday_n
    FROM h LEFT JOIN f ON f.hr = h.hr GROUP BY h.hr
    """,
)
def hourly_compare(spark, d):
    return metrics.hourly_compare(_launches(spark, d), DAY)


KPI_SQL = f"""
WITH {LAUNCHES}, first_seen AS (SELECT mid, min(dt) AS dt FROM l GROUP BY mid),
k AS (
  SELECT 'dau' AS id, '{KPI_NAMES["dau"]}' AS name, count(DISTINCT mid) AS value FROM l WHERE dt = '{DAY}'
  UNION ALL
  SELECT 'new_mid', '{KPI_NAMES["new_mid"]}', count(*) FROM first_seen WHERE dt = '{DAY}'
)"""


@query("kpi_totals", f"{KPI_SQL} SELECT id, name, value FROM k")
def kpi_totals(spark, d):
    return metrics.kpi_totals(_launches(spark, d), DAY)


@query(
    "realtime_total",
    f"""{KPI_SQL}
    SELECT '[' || string_agg('{{"id":"' || id || '","name":"' || name || '","value":' || value || '}}', ',' ORDER BY id)
           || ']' AS body FROM k
    """,
)
def realtime_total(spark, d):
    return dashboard.realtime_total(_launches(spark, d), DAY)


@query(
    "realtime_hour",
    f"""
    WITH {FIRST_HOURS}, c AS (SELECT dt, hr, count(*) AS n FROM f GROUP BY dt, hr)
    SELECT '{{"yesterday":{{' ||
           coalesce(string_agg('"' || hr || '":' || n, ',' ORDER BY hr)
             FILTER (WHERE dt = CAST(DATE '{DAY}' - 1 AS VARCHAR)), '') || '}},"today":{{' ||
           coalesce(string_agg('"' || hr || '":' || n, ',' ORDER BY hr) FILTER (WHERE dt = '{DAY}'), '') ||
           '}}}}' AS body
    FROM c
    """,
)
def realtime_hour(spark, d):
    return dashboard.realtime_hour(_launches(spark, d), DAY)


@query(
    "new_devices",
    f"WITH {LAUNCHES} SELECT dt, count(*) AS n FROM (SELECT mid, min(dt) AS dt FROM l GROUP BY mid) GROUP BY dt",
)
def new_devices(spark, d):
    return metrics.new_devices(_launches(spark, d))


@query("launch_count", f"WITH {LAUNCHES} SELECT dt, count(*) AS n FROM l GROUP BY dt")
def launch_count(spark, d):
    return metrics.launch_count(_launches(spark, d))


@query(
    "kpi_day_over_day",
    f"""
    WITH {LAUNCHES},
    k AS (
      SELECT 'dau' AS id, dt, count(DISTINCT mid) AS value FROM l GROUP BY dt
      UNION ALL SELECT 'launches', dt, count(*) FROM l GROUP BY dt
      UNION ALL SELECT 'new_mid', dt, count(*) FROM (SELECT mid, min(dt) AS dt FROM l GROUP BY mid) GROUP BY dt
    ),
    days AS (
      SELECT id, strftime(unnest(generate_series(min(CAST(dt AS DATE)), max(CAST(dt AS DATE)), INTERVAL 1 DAY)), '%Y-%m-%d') AS dt
      FROM k GROUP BY id
    ),
    v AS (SELECT id, dt, coalesce(k.value, 0) AS value FROM days LEFT JOIN k USING (id, dt)),
    p AS (SELECT *, lag(value) OVER (PARTITION BY id ORDER BY dt) AS previous FROM v)
    SELECT id, dt, value, previous, (value - previous) * 100.0::DOUBLE / nullif(previous, 0) AS change_pct FROM p
    """,
)
def kpi_day_over_day(spark, d):
    series = metrics.kpi_series(metrics.daily_kpis(_launches(spark, d)))
    # A KPI's series runs from its first to its last day with a count.
    return metrics.kpi_day_over_day(series.filter(F.col("value") > 0))


@query(
    "daily_kpis",
    f"""
    WITH {LAUNCHES}, first_seen AS (SELECT mid, min(dt) AS dt FROM l GROUP BY mid)
    SELECT dt, count(DISTINCT mid) AS dau, count(*) AS launches,
           (SELECT count(*) FROM first_seen s WHERE s.dt = l.dt) AS new_mid
    FROM l GROUP BY dt
    """,
)
def daily_kpis(spark, d):
    return metrics.daily_kpis(_launches(spark, d)).withColumn("dt", F.col("dt").cast("string"))


@query(
    "kpi_tiles",
    f"""
    WITH {LAUNCHES}
    SELECT dt, format('{{:,}}', count(DISTINCT mid)) AS dau, format('{{:,}}', count(*)) AS launches, dt >= CAST(current_date AS VARCHAR) AS open
    FROM l GROUP BY dt
    """,
)
def kpi_tiles(spark, d):
    """The figures of a day as its tiles show them, and whether the day still counts."""
    tile = lambda c: labels.thousands(F.col(c)).alias(c)
    daily = metrics.daily_kpis(_launches(spark, d)).withColumn("dt", F.col("dt").cast("string"))
    return daily.select("dt", tile("dau"), tile("launches"), (F.col("dt") >= today_text()).alias("open"))


@query(
    "dau_cumulative",
    f"""
    WITH {FIRST_HOURS}, h AS (SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hr FROM range(24) t(i)),
    c AS (
      SELECT days.dt, h.hr, count(f.mid) AS n
      FROM (SELECT DISTINCT dt FROM f) days CROSS JOIN h LEFT JOIN f ON f.dt = days.dt AND f.hr = h.hr
      GROUP BY days.dt, h.hr
    )
    SELECT dt, hr, n, CAST(sum(n) OVER (PARTITION BY dt ORDER BY hr) AS BIGINT) AS total_n FROM c
    """,
)
def dau_cumulative(spark, d):
    return metrics.dau_cumulative(metrics.dau_hour(_launches(spark, d)))


# ---------------------------------------------------------------- order details


def _sales(spark, d, date=None):
    return sale.build_sale_detail(tables.order_detail(spark, d, date), tables.users(spark, d), tables.skus(spark, d))


SALE_ORDER = ", ".join(f"{c} NULLS LAST" for c in sale.SALE_DETAIL_COLUMNS)


@query(
    "sale_detail_page",
    f"WITH {SALES} SELECT * FROM s WHERE dt = '{SALE_DAY}' ORDER BY {SALE_ORDER} LIMIT 10 OFFSET 10",
)
def sale_detail_page(spark, d):
    lines = tables.order_detail(spark, d, SALE_DAY)
    return sale.page_of_lines(lines, tables.users(spark, d), tables.skus(spark, d), page=2, size=10)


@query(
    "sale_detail_keyword",
    f"""
    WITH {SALES} SELECT * FROM s
    WHERE list_has_any(string_split(sku_name, ' '), ['red', 'ring']) AND user_level = 3
    ORDER BY {SALE_ORDER} LIMIT 50
    """,
)
def sale_detail_keyword(spark, d):
    """First page of 50 over all days: any keyword token in the SKU name, one user level."""
    users, skus = tables.users(spark, d), tables.skus(spark, d)
    lines = sale.matching_lines(tables.order_detail(spark, d), users, skus, "Red ring", level=3)
    return sale.page_of_lines(lines, users, skus, page=1, size=50)


@query(
    "sale_detail_total",
    f"WITH {SALES} SELECT count(*) AS total FROM s WHERE list_has_any(string_split(sku_name, ' '), ['red', 'ring'])",
)
def sale_detail_total(spark, d):
    """Counted on the order lines alone; no user is joined."""
    lines = sale.matching_lines(tables.order_detail(spark, d), tables.users(spark, d), tables.skus(spark, d), "Red ring")
    return sale.sale_detail_total(lines)


@query(
    "sale_detail_deep_page",
    f"""
    WITH {SALES} SELECT *, row_number() OVER (ORDER BY {SALE_ORDER}) AS place FROM s
    QUALIFY place BETWEEN 29991 AND 30000
    """,
)
def sale_detail_deep_page(spark, d):
    """Page 3,000 of all lines: laid out in ranges, its parts found by running sums of their counts."""
    path = scratch_dir(spark, "grid")
    write_ranged(_sales(spark, d), path, sale.SALE_SORT, parts=16)
    page = ranged_page(read_ranged(spark, path), sale.SALE_SORT, page=3000, size=10)
    return page.select(*sale.SALE_DETAIL_COLUMNS, F.col("place").cast("long"))


@query(
    "sale_detail_response",
    f"""
    WITH {SALES},
    q AS (SELECT 4 AS draw, * FROM s WHERE dt = '{SALE_DAY}' UNION ALL SELECT 5, * FROM s WHERE dt = '{DEFAULT_SALE_DATE}'),
    a AS (SELECT draw, CASE WHEN user_age < 20 THEN '{AGE_UNDER_20}' WHEN user_age <= 30 THEN '{AGE_20_TO_30}' ELSE '{AGE_OVER_30}' END AS name
          FROM q WHERE user_age IS NOT NULL),
    g AS (SELECT draw, CASE user_gender WHEN 'M' THEN '{GENDER_NAMES["M"]}' ELSE '{GENDER_NAMES["F"]}' END AS name FROM q WHERE user_gender IS NOT NULL),
    p AS (SELECT *, row_number() OVER (PARTITION BY draw ORDER BY {SALE_ORDER}) AS pos FROM q)
    SELECT d.draw, 'total' AS kind, 0 AS pos, '' AS name, (SELECT count(*) FROM q WHERE q.draw = d.draw)::DOUBLE AS value
    FROM (VALUES (4), (5)) d(draw)
    UNION ALL SELECT draw, 'detail', CAST(pos - 6 AS INTEGER), order_detail_id || ' ' || coalesce(sku_name, ''), sku_price FROM p WHERE pos BETWEEN 6 AND 10
    UNION ALL SELECT draw, 'age', 0, name, count(*) FROM a GROUP BY draw, name
    UNION ALL SELECT draw, 'gender', 0, name, count(*) FROM g GROUP BY draw, name
    """,
)
def sale_detail_response(spark, d):
    """Second page of 5 of one day, and of the default day, out of the JSON bodies."""
    path = scratch_dir(spark, "grid")
    sale.write_sale_detail(_sales(spark, d), path)
    response = dashboard.sale_detail_response
    bodies = response(spark, path, 4, 2, 5, SALE_DAY).union(response(spark, path, 5, 2, 5))
    option = "array<struct<name:string,value:double>>"
    shape = f"draw int, data struct<total:double,detail:array<struct<order_detail_id:string,sku_name:string,sku_price:double>>,stat:array<struct<options:{option}>>>"
    body = bodies.select(F.from_json("body", shape).alias("b")).select("b.draw", "b.data.*")
    row = lambda kind, pos, name, value: F.struct(F.lit(kind).alias("kind"), pos.cast("int").alias("pos"), name.alias("name"), value.alias("value"))
    lines = F.transform("detail", lambda x, i: row("detail", i, F.concat_ws(" ", x["order_detail_id"], F.coalesce(x["sku_name"], F.lit(""))), x["sku_price"]))
    share = lambda kind, i: F.transform(F.col("stat")[i]["options"], lambda x: row(kind, F.lit(0), x["name"], x["value"]))
    total = F.array(row("total", F.lit(0), F.lit(""), F.col("total")))
    return body.select("draw", F.inline(F.concat(total, lines, share("age", 0), share("gender", 1))))


def _user_groups(spark, d):
    per_order = tables.units_by_order(spark, d).join(tables.order_users(spark, d), "order_id")
    return sale.user_groups(per_order, tables.users(spark, d), weight="n")


@query(
    "age_facet",
    f"""
    WITH {SALES},
    g AS (SELECT CASE WHEN user_age < 20 THEN '{AGE_UNDER_20}' WHEN user_age <= 30 THEN '{AGE_20_TO_30}' ELSE '{AGE_OVER_30}' END AS name,
                 count(*) AS value FROM s WHERE user_age IS NOT NULL GROUP BY 1)
    SELECT 'age' AS facet, name, value, value * 100.0::DOUBLE / sum(value) OVER () AS pct FROM g
    """,
)
def age_facet(spark, d):
    return sale.age_facet(_user_groups(spark, d))


@query(
    "gender_facet",
    f"""
    WITH {SALES},
    g AS (SELECT CASE user_gender WHEN 'M' THEN '{GENDER_NAMES["M"]}' ELSE '{GENDER_NAMES["F"]}' END AS name, count(*) AS value
          FROM s WHERE user_gender IS NOT NULL GROUP BY 1)
    SELECT 'gender' AS facet, name, value, value * 100.0::DOUBLE / sum(value) OVER () AS pct FROM g
    """,
)
def gender_facet(spark, d):
    return sale.gender_facet(_user_groups(spark, d))


@query(
    "region_sales",
    """
    WITH r AS (
      SELECT n.n_name AS name, sum(l.l_quantity) / 1000 AS value
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
      JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY n.n_name
    )
    SELECT name, value, CAST(CASE WHEN value = 600 THEN 5 WHEN value >= 0 AND value < 600 THEN floor(value / 100) END AS INTEGER) AS bin
    FROM r
    """,
)
def region_sales(spark, d):
    """Thousand units sold by nation, with the colour band."""
    per_order = tables.units_by_order(spark, d).join(tables.order_users(spark, d), "order_id")
    sales = per_order.select("user_id", F.col("units").alias("value"))
    return sale.region_sales(sales, tables.users(spark, d), tables.regions(spark, d), unit=1000.0)


@query(
    "category_sales",
    """
    SELECT p.p_type AS name, CAST(sum(l.l_quantity) AS BIGINT) AS num
    FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_type
    """,
)
def category_sales(spark, d):
    lines = tables.table(spark, d, "lineitem")
    sales = lines.select(F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("decimal(18,4)").alias("num"))
    return sale.category_sales(sales, tables.skus(spark, d))


@query(
    "category_list",
    """
    WITH c AS (SELECT p.p_type AS name, CAST(sum(l.l_quantity) AS BIGINT) AS num
               FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_type)
    SELECT '{"data":[' || string_agg('{"name":"' || name || '","num":' || num || '}', ',' ORDER BY name) || ']}' AS body
    FROM c
    """,
)
def category_list(spark, d):
    known = category_sales(spark, d).filter(F.col("name").isNotNull())
    return dashboard.named_list(known, "name", "num", wrap="data")


# ---------------------------------------------------------------- search


@query(
    "search_after",
    """
    SELECT p_partkey AS id, p_name AS name, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS score FROM part
    WHERE CAST(p_retailprice AS FLOAT) < 950 OR (CAST(p_retailprice AS FLOAT) = 950 AND p_partkey > 50)
    ORDER BY score DESC, id LIMIT 20
    """,
)
def search_after_query(spark, d):
    """The page after the row with score 950 and id 50."""
    page = search_after(tables.nested_documents(spark, d), [("doubanScore", "desc"), ("id", "asc")], [950.0, 50], 20)
    return page.select("id", "name", F.col("doubanScore").cast("double").alias("score"))


@query(
    "search_match_term",
    """
    SELECT p_partkey AS id, p_name AS name, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS score,
           regexp_replace(p_name, '(ring|gear)', '<em>\\1</em>', 'g') AS name_hl
    FROM part
    WHERE list_has_any(string_split(p_name, ' '), ['ring', 'gear']) AND (p_brand = 'Brand#7' OR p_type = 'Brand#7')
    ORDER BY score DESC, id LIMIT 20
    """,
)
def search_match_term(spark, d):
    docs = tables.nested_documents(spark, d)
    hits = search(
        docs,
        must=[match_text(F.col("name"), "Ring gear")],
        filters=[term_in_array(F.col("actorList"), "name", "Brand#7")],
        sort=[("doubanScore", "desc"), ("id", "asc")],
        offset=0,
        size=20,
        highlights={"name": "Ring gear"},
    )
    return hits.select("id", "name", F.col("doubanScore").cast("double").alias("score"), "name_hl")


@query(
    "upsert_documents",
    """
    SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN 'promo ' || p_name ELSE p_name END AS name,
           CAST(CAST(CASE WHEN p_type = 'PROMO' THEN p_retailprice / 2 ELSE p_retailprice END AS FLOAT) AS DOUBLE) AS score,
           CAST(2 AS INTEGER) AS entries
    FROM part
    """,
)
def upsert_documents_query(spark, d):
    """All parts as documents, then the promotion parts written again with a new name and half the price."""
    path = scratch_dir(spark, "documents")
    docs = tables.nested_documents(spark, d)
    upsert_documents(docs, path, 0)
    promo = docs.filter(term_in_array(F.col("actorList"), "name", "PROMO"))
    changed = {"name": F.concat(F.lit("promo "), "name"), "doubanScore": (F.col("doubanScore") / 2).cast("float")}
    upsert_documents(promo.withColumns(changed), path, 1)
    newest = read_documents(spark, path, docs.schema)
    return newest.select("id", "name", F.col("doubanScore").cast("double").alias("score"), F.size("actorList").alias("entries"))


@query(
    "merged_documents",
    """
    SELECT p_partkey AS id, 'v' || list_max([v FOR v IN range(20) IF p_partkey % (v + 1) = 0]) || ' ' || p_name AS name,
           true AS few_folders
    FROM part
    """,
)
def merged_documents(spark, d):
    """Twenty versions, each of every (v + 1)-th part, merged by size as they come."""
    path, docs = scratch_dir(spark, "documents"), tables.nested_documents(spark, d)
    for v in range(20):
        own = docs.filter(F.col("id") % (v + 1) == 0).withColumn("name", F.concat(F.lit(f"v{v} "), "name"))
        upsert_documents(own.coalesce(1), path, v)
        if v % 4 == 3:
            merge_documents(spark, path, docs.schema, grace=0)
    few = F.lit(len(live_folders(spark, path)) < 8)
    return read_documents(spark, path, docs.schema).select("id", "name", few.alias("few_folders"))


@query(
    "match_documents",
    """
    WITH t AS (
      SELECT lang, source,
             regexp_extract_all(
               regexp_replace(lower(text), '([\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{323AF}])', ' \\1 ', 'g'),
               '[\\p{L}\\p{N}]+') AS tok
      FROM documents
    )
    SELECT lang, source, count(*) AS docs, count(*) FILTER (WHERE list_has_any(tok, ['license', 'une'])) AS any_n,
           count(*) FILTER (WHERE list_has_all(tok, ['license', 'the'])) AS all_n
    FROM t GROUP BY lang, source
    """,
)
def match_documents(spark, d):
    """Whole-text match counts, any and all tokens."""
    text = F.col("text")
    return (
        tables.table(spark, d, "documents")
        .groupBy("lang", "source")
        .agg(
            F.count("*").alias("docs"),
            F.count_if(match_text(text, "license une")).alias("any_n"),
            F.count_if(match_text(text, "license the", operator="and")).alias("all_n"),
        )
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
