"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full with the ``noop`` sink (every row computed, nothing collected to the driver).
Before the timed pass, the same queries run once on the sf0.01 tables next to ``$BENCH_SF_DIR`` (when present), so
generated code is compiled and the JVM is warm, as on long-running executors; only the pass at ``$BENCH_SF_DIR`` is
timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from granary.plans import catalog  # noqa: E402
from granary.session import get_session  # noqa: E402

HEADLINE = [
    "progress_by_year",
    "overall_status",
    "current_job_logs",
    "attempt_history",
    "event_lookup",
    "status_from_snapshot",
    "inventory_convert",
    "feed_plan",
    "next_batch",
    "job_outcomes",
    "routed_events",
    "failures_view",
    "requeue",
    "report_grid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="granary-bench")
    spark.sparkContext.setLogLevel("ERROR")

    # warm-up pass on the small tables: same plans, so code generation and JIT are done before timing
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
