"""Median seconds and shuffles per registered query; prints one JSON line.

The shuffles are those of the returned plan; what a query stores before is timed but not counted.
Tables in buckets are stored once a session, when a query first asks for them: mostly in a warm-up run.

BENCH_SF_DIR  folder of the tables       (default /root/testdata/sf0.1)
BENCH_CPUS    local threads              (default 4)
BENCH_RUNS    timed runs per query       (default 3, after one warm-up; fewer once a query took ten seconds)
BENCH_ONLY    comma-separated query names
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession

from lendsight.plans.catalog import QUERIES


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_ONLY", ",".join(QUERIES)).split(",")

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lendsight-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds, shuffles = {}, {}
    for name in names:
        timed = []
        while len(timed) < 2 or (len(timed) <= runs and sum(timed) < 10):
            start = time.perf_counter()
            df = QUERIES[name](spark, folder)
            df.write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timed[1:]), 4)
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles[name] = len(re.findall(r"\bExchange (?:hash|range|Single)", plan))
        print(f"{name:32s} {seconds[name]:8.3f}  (first {timed[0]:.3f})", file=sys.stderr)
    spark.stop()

    result = {
        "metric": "total_median_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "shuffles": shuffles,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
