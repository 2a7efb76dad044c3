"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Each query is run once to warm up and then
``RUNS`` times into a sink that takes every row and keeps none; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registered.queries import QUERIES  # noqa: E402

HEADLINE = (
    "daily_fact",
    "monthly_fact",
    "scd2_initial",
    "scd2_merge",
    "stage_airport",
    "surrogate_key",
    "profile_table",
    "airline_dashboard",
    "airport_dashboard",
    "plane_dashboard",
    "holiday_trend",
    "route_dashboard",
)
RUNS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    medians = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        medians[name] = round(statistics.median(seconds[1:]), 3)
    result = {
        "metric": "headline_queries_median_total",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
