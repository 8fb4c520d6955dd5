"""Headline-query bench.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query once to warm the JVM/caches on the same data, then
times two full executions (``write.format("noop")``: every row is computed,
nothing is collected to the driver) and keeps the faster one — the shared
host this runs on shows large run-to-run noise.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_sales",
    "freight_allocation",
    "customer_segments",
    "sales_by_sku_day",
    "margin_audit",
    "scd2_state",
    "interval_subtract",
    "experiment_consolidate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from marginflow.session import local_session
    from marginflow.registry import QUERIES

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="marginflow-bench")
    times = {}
    for k in HEADLINE:
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        best = None
        for _ in range(2):
            t = time.time()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - t) if best is not None else time.time() - t
        times[k] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
