"""Write small stored tables, then print the plan lines that show pruning and push-down for the scale-critical paths.

Usage: python scripts/plan_check.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from granary.operators import feed, inventory, reporting  # noqa: E402
from granary.plans import catalog  # noqa: E402
from granary.plans import fixtures as fx  # noqa: E402
from granary.session import get_session  # noqa: E402
from granary.sources import inventory as inv_src  # noqa: E402
from granary.sources import joblogs, snapshot  # noqa: E402


def _explain(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def show(title: str, df, patterns: list[str]) -> None:
    text = _explain(df)
    print(f"## {title}")
    for line in text.splitlines():
        if any(re.search(p, line) for p in patterns):
            print("    " + line.strip()[:260])
    print()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="granary-plans-")

    inv_src.write_inventory(inventory.convert_inventory(fx.raw_inventory(spark, sf_dir)), f"{base}/inventory")
    table = inv_src.read_inventory(spark, f"{base}/inventory", ["inventory", "inventory_seq", "granule_id", "status"])
    s = feed.Slice("b-cumulus-rds-granules.parquet", 100, 150)
    show("Feed slice on the stored inventory (O3)", feed.slice_rows(table, s),
         ["PartitionFilters", "PushedFilters", "ReadSchema"])

    snapshot.write_snapshot(fx.log_snapshot(spark, sf_dir).select(
        "key", "is_latest", "is_delete_marker", "last_modified_date", "dt"), f"{base}/snapshot")
    view = reporting.processing_events_view(snapshot.read_snapshot(spark, f"{base}/snapshot"))
    show("Listing view over the dt-partitioned snapshot (V1, F5)", view,
         ["PartitionFilters", "PushedFilters", "ReadSchema", "Subquery", "dynamicpruning"])

    joblogs.write_job_logs(catalog._job_log(spark, sf_dir), f"{base}/logs")
    show("Failure view over the partitioned JSON log (V2, F6)",
         reporting.failures_view(joblogs.read_job_logs(spark, f"{base}/logs")),
         ["PartitionFilters", "ReadSchema", "Exchange", "Aggregate"])

    show("Flagship report from the attempt history", catalog.QUERIES["progress_by_year"](spark, sf_dir),
         ["Exchange", "Aggregate", "Join", "Window"])
    show("Log-state replay (W1)", catalog.QUERIES["current_job_logs"](spark, sf_dir),
         ["Exchange", "Aggregate", "Join", "Window", "Sort \\("])
    spark.stop()


if __name__ == "__main__":
    main()
