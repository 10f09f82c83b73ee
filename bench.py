"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up, then three times into a sink that discards the rows;
the median is reported, and `value` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "scan_parquet",
    "landing_query",
    "normalize_text",
    "filter_valid_readings",
    "clean_indicators",
    "daily_stats",
    "job_daily_readings",
    "yearly_stats",
    "combine_yearly",
    "corr_vs_anchor",
    "corr_combined",
    "describe_long",
    "null_profile",
    "validate_combined",
    "document_ids",
    "document_ids_hash",
    "document_positions",
    "document_ndjson",
    "search_documents",
    "search_facets",
    "terms_topk",
    "daily_run_documents",
)
RUNS = 3


def run(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(RUNS)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
