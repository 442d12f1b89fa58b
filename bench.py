"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated
names), BENCH_RUNS (timed runs after one warm-up, the median counts; default 1).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "d12_fact_daily", "d13_conform", "d14_daily_market_snapshot", "d15_host_performance", "d16_neighbourhood_trends",
    "d17_daily_market_summary", "d18_listing_dataset", "d19_listing_features", "d01_clean_listings", "d02_clean_calendar",
    "q03_profile_many", "w02_distributed_key", "a09_median_by", "a17_describe", "a23_regression_metrics", "j05_star_join",
    "s07_new_files", "f03_keyword_flags", "f33_html_headings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from pyspark.sql import SparkSession

    from marketlake.verification import QUERIES

    folder = tempfile.mkdtemp(prefix="marketlake-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("marketlake-bench")
        .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder).config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
