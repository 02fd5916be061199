"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data directory, ``BENCH_CPUS`` the number of local cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times (default 5; at most 3 where the warm-up took over five
seconds); the median counts. Results go to Spark's ``noop`` sink, so every row and column is computed and
nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from contract.registry import QUERIES

HEADLINE = (
    "top_groups",
    "top_n_per_year",
    "top_lines_per_year",
    "avg_by_group",
    "group_summary",
    "yearly_trends",
    "dedup",
    "dedup_earliest",
    "normalize_text",
    "conform_rescue",
    "row_counts",
    "distinct_counts",
    "top_n_deep",
    "chunks",
    "chunks_hot_key",
    "chunks_scan_order",
    "write_chunks",
    "row_index",
    "ingest_incremental",
    "silver_streaming",
    "gold_tables",
)


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tierflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = min(runs, 3) if run(spark, name, sf_dir) > 5 else runs
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(times)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
