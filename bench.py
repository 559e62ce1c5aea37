"""Times every registered query and prints one JSON line.

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 3); the median counts
BENCH_ONLY    comma-separated query names (default all)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from firstlight.plans import catalog  # noqa: E402
from firstlight.session import build_session  # noqa: E402

# These write files and run streams on every call.
ONCE = {
    "first_per_day_stream", "dau_total_stream", "raw_landing_daily", "routed_topics", "compacted_day", "store_day_total",
    "kpi_totals_first_seen", "dau_hour_incremental", "new_devices_incremental", "batch_written", "arrivals_with_expiry", "get_device_day",
    "launches_hourly_stream", "ingest_one_pass", "merged_documents", "sale_detail_response", "sale_detail_deep_page",
}


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name, query in catalog.queries().items():
        if only and name not in only:
            continue
        seconds(spark, query, sf_dir)
        timings[name] = round(statistics.median(seconds(spark, query, sf_dir) for _ in range(1 if name in ONCE else runs)), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {
        "metric": "total seconds of all queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if "first_per_day_stream" in timings:
        result["stream_rows_per_sec"] = round(rows / timings["first_per_day_stream"])
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
