"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of test tables; BENCH_CPUS: local threads; BENCH_RUNS: runs
per query, of which the fastest counts. All rows and columns are computed (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from basketry.plans.queries import registry

HEADLINE = [
    "purchase_history",
    "periods",
    "customers",
    "groups",
    "groups_margin_last_n",
    "avg_check_by_count",
    "offers_average_check_period",
    "offers_average_check_count",
    "offers_visit_frequency",
    "offers_cross_sell",
    "validate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    seconds: dict[str, float] = {}
    medians: dict[str, float] = {}
    slowest: dict[str, float] = {}
    for name in names:
        timings = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(min(timings), 3)
        medians[name] = round(statistics.median(timings), 3)
        slowest[name] = round(max(timings), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "median": medians,
                "slowest": slowest,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
