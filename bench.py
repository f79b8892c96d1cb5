"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). Every query runs
once to warm up and then three times into a sink that discards its rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from clickmill.registry.queries import REGISTRY
from clickmill.session import build_session

HEADLINE = [
    "bronze_export_projection", "silver_enriched_events", "silver_enriched_shuffled", "customer_profile",
    "funnel_hourly", "funnel_daily", "rfm_hourly", "rfm_daily", "rfm_daily_distributed", "rfm_global",
    "session_assignment", "session_performance_daily", "product_sales", "dedup_events", "hot_cold_union",
    "event_json_roundtrip",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus), {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
    print(json.dumps({"metric": "headline query time, sum of medians", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
