"""Time the registered queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs after
one warm-up (the median counts), BENCH_QUERIES a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from seqtables.plans.registry import QUERIES
from seqtables.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
NAMES = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, CPUS)
    times = {}
    for name in NAMES:
        seconds(spark, name)
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS, "runs": RUNS, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
