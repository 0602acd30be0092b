"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fleetgauge.plans.catalog import QUERIES
from fleetgauge.session import local_session

HEADLINE = [
    "clean_typed", "reject_counts", "message_outcomes", "outcome_counts", "stored_rows", "tenant_stats", "global_stats",
    "device_last_n_stats", "device_rolling", "device_last_seen", "latency_histogram", "tenant_page", "recent_then_tenant",
    "newer_only", "chart_last_20", "running_average", "fanout", "api_key_status", "retention_survivors",
    "retention_deleted_counts", "tenant_changes", "daily_quota", "rows_over_rate_limit", "analytics_result", "counter_rate",
    "histogram_p95",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "events": rows, "cpus": cpus,
        "rows_per_second": {n: round(rows / s) for n, s in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
