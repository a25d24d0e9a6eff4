"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is planned and
run from its files into a sink that discards the rows; the median of the runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlake.workload import QUERIES  # noqa: E402

HEADLINES = (
    "day_key_counts",
    "day_key_join",
    "per_app",
    "per_app_literal",
    "engagement_daily",
    "revenue_daily",
    "report_grain",
    "flatten_insights",
    "event_metrics",
    "expand_actions",
    "subscribe_revenue",
    "report_merge",
    "ads_metrics",
    "ga4_events",
    "play_installs",
    "inline_ads",
    "ad_request_stats",
    "merge_upsert",
    "changed_rows",
    "enrich",
    "first_wins",
    "backfill_validate",
    "apply_backfill",
    "plan_windows",
    "rolling_refresh",
    "capped_pull",
    "cdc_apply",
    "cdc_decode",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    line = {
        "metric": "headline queries, median seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
