"""Wall seconds of every registered query, as one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS`` (timed runs
after one warm-up; the median counts), ``BENCH_ONLY`` (comma list of query names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tidemark.plans.queries import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, run) -> float:
    """Seconds to build the query and to compute every row of its result."""
    start = time.perf_counter()
    run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}
    for name, run in queries().items():
        if ONLY and name not in ONLY:
            continue
        timed(spark, run)
        seconds[name] = round(statistics.median(timed(spark, run) for _ in range(RUNS)), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    result = {
        "metric": "landing_queries_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rsplit("/sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
