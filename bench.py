"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all),
BENCH_RUNS (default 3). Each query runs once to warm up and then BENCH_RUNS times; the median
is reported. Results go to Spark's no-op sink, so every row and column is computed. The two feeds are landed as files before, outside
the times, as a job's input is; queries read these and derive nothing from the sample tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from roadgauge.plans import catalogue  # noqa: E402
from roadgauge.session import build, own_folders, scratch_dir  # noqa: E402
from roadgauge.sources import sample  # noqa: E402

HEADLINE = (
    "a4_daily_fleet_summary", "a1_vehicle_day_trips", "a5_vehicle_day_rollup", "a6_delivery_day_rollup",
    "a7_count_all", "a8_count_by_day", "a9_one_day_speed", "a10_status_summary", "t3_top_vehicles",
    "a12_daily_delivery_performance", "a13_hourly_utilization", "a14_delivery_performance", "a15_driver_leaderboard",
    "a16_current_fleet_status", "a17_delivery_counters", "k10_alerts", "w1_keep_latest_gps",
    "w2_keep_latest_deliveries", "w5_attempt_numbers", "w6_trip_segmentation", "j11_driver_as_of", "p17_geohash",
    "x3_sliding_fleet_metrics_batch", "x4_sliding_delivery_kpis_batch", "c3_upsert_merge",
)


def timed(spark, run) -> float:
    with own_folders(spark):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = build(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false", spark__driver__memory="12g",
        spark__sql__files__maxPartitionBytes="16m", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    sample.land(spark, folder, scratch_dir(spark, "landed"))
    times = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        run = catalogue.QUERIES[name]
        timed(spark, lambda: run(spark, folder))
        times[name] = round(statistics.median(timed(spark, lambda: run(spark, folder)) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus), "runs": runs,
        "memory_gib": round(os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES") / 2 ** 30),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
