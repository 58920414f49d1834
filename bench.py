"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query, the median counts (default 3)
BENCH_QUERIES  comma-separated subset of the catalogue, or "all"
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from quarterdeck.plans.catalogue import QUERIES  # noqa: E402

HEADLINE = (
    "best_year",
    "best_year_sql",
    "best_year_single",
    "period_rule_audit",
    "range_stats",
    "keyed_value_with_reference",
    "coverage_gaps",
    "coverage_gaps_by_key",
    "dedupe_by_key",
    "labelled_facts",
    "lookup_resolution",
    "expect_metrics",
    "rescue_malformed",
    "listing_links",
    "landing_reconcile",
    "manifest_seen",
    "latest_snapshot",
    "report_top10",
    "report_best_table",
    "highest_series",
    "stream_ingest",
    "medallion_flow",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quarterdeck-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        runs = []
        for i in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # the first run pays for class loading and code generation
                runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 4)
    spark.stop()

    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
