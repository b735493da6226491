"""Time every registered query (warm, median of N) and print a markdown table.

Usage: python tools/time_queries.py [sf_dir] [repeats]
Each run builds the query (including its checkpoints and broadcast checks) and
executes it fully into the ``noop`` sink.
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pnlflow.plans import queries as Q  # noqa: E402
from pnlflow.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeats = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = local_session()
    Q.run("d11_full_pnl", spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    print("| query | median sec | rows |")
    print("|---|---|---|")
    for name in Q.REGISTRY:
        times = []
        for _ in range(repeats):
            t = time.perf_counter()
            Q.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        rows = Q.run(name, spark, sf_dir).count()
        print(f"| {name} | {statistics.median(times):.2f} | {rows} |", flush=True)


if __name__ == "__main__":
    main()
