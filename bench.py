"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians, sec),
"unit", "queries" {name: median sec}, "sf", ...}.  Each query is run to
completion with the ``noop`` sink (full computation, no driver collect);
one warm-up run, then the median of ``BENCH_RUNS`` runs.  Nothing is kept
between runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "clips_single", "clips_multi_v2", "clips_scene", "segments",
    "sessions_last", "sessions_max", "sessions_window", "clips_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from framecut.plans.catalog import QUERIES
    from framecut.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="framecut-bench")
    names = only or list(HEADLINE)
    # warm-up: JVM, codegen and file listing
    QUERIES["clips_single"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    results = {}
    for name in names:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
