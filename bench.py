"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed (``noop`` sink, no collect to the
driver); after one warm-up pass every query is timed three times and the
median is reported.  Prints one JSON line.
"""

from __future__ import annotations

import gc
import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pnlflow.plans import queries as Q  # noqa: E402
from pnlflow.session import local_session  # noqa: E402

HEADLINE = ["d11_full_pnl", "a01_ledger_base", "d03_cascade_allocate", "d05_reconcile_delta", "d06_convert_fx",
            "d09_planning_net_revenue"]


def run_once(spark, name: str, sf_dir: str) -> float:
    # release the previous run's plans, broadcasts and checkpoint references first
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    t = time.perf_counter()
    Q.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8),
                          app="pnlflow-bench")
    for n in names:  # warm-up: JIT, file listing, broadcast checks
        run_once(spark, n, sf_dir)
    timings = {n: statistics.median(run_once(spark, n, sf_dir) for _ in range(repeats)) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
