"""Time the registered queries; prints one JSON line.

Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (best of n).  Every query is run
in full and its result counted through a no-op sink, so no column is pruned.
Streams (``stream_*``) are timed once and listed, but not part of the total: most
of their time is the start and end of micro-batches.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulseweave import build_session  # noqa: E402
from pulseweave.plans import streams  # noqa: E402,F401  registers the queries over streams
from pulseweave.plans.catalog import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    spark = build_session("pulseweave-bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    # Start the JVM's and the Python workers' warm-up outside the timings.
    for name in ("minutely", "drift_alerts"):
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        best = None
        for _ in range(1 if name.startswith("stream_") else RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 4)
    spark.stop()
    print(json.dumps({
        "metric": "total time of all registered queries but streams",
        "value": round(sum(t for n, t in times.items() if not n.startswith("stream_")), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
