"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_RUNS`` times (default 3) with
its result written to the ``noop`` sink; the median is reported. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lucrum.config import build_session  # noqa: E402
from lucrum.queries import REGISTRY  # noqa: E402

HEADLINE = ["gold_net_margin", "latest_order_item", "freight_allocation",
            "upsert_order_items", "flatten_order_items"]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          app_name="lucrum-bench")
    timings: dict[str, float] = {}
    for name in names:
        run_once(spark, name, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir)
                                                for _ in range(runs)), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
