"""Stored inventories: written once, in order, with a catalogue of files; counts from footers; slices that name their files."""

from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from granary.operators import inventory
from granary.plans import jobs
from granary.sources import inventory as inv_src
from granary.sources import progress as prog

ROWS = "inventory string, granule_id string, start_datetime timestamp, status string, published boolean"


def some_rows(n, names=("a b+c%d:e-cumulus-rds-granules.parquet", "z-cumulus-rds-granules.parquet")):
    rng = random.Random(n)
    days = [dt.datetime(2021, 1, 1 + rng.randrange(5)) for _ in range(n)]
    return [(rng.choice(names), f"g{i:05d}", rng.choice([d, d, None]), rng.choice(["completed", "queued"]), True) for i, d in enumerate(days)]


def stored(spark, scratch, n=400, partitions=7):
    frame = spark.createDataFrame(some_rows(n), ROWS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        inv_src.write_ordered(frame, f"{scratch}/inv", inventory.inventory_order())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    key = lambda r: (r[0], r[2] is None, -(r[2] or dt.datetime(2000, 1, 1)).timestamp(), r[1])
    want: dict = {}
    for row in sorted(some_rows(n), key=key):
        want.setdefault(row[0], []).append((row[1], row[3]))
    return want


def test_positions_come_from_files_in_order(spark, scratch):
    want = stored(spark, scratch)
    files = inv_src.read_catalog(spark, f"{scratch}/inv").collect()
    assert len(files) > 4 and sum(f["rows"] for f in files) == 400
    rows = inv_src.read_inventory(spark, f"{scratch}/inv", ["inventory", "inventory_seq", "granule_id", "status"]).collect()
    found: dict = {}
    for r in sorted(rows):
        assert r["inventory_seq"] == len(found.setdefault(r["inventory"], []))
        found[r["inventory"]].append((r["granule_id"], r["status"]))
    assert found == want


def test_counts_read_no_column(spark, scratch):
    want = stored(spark, scratch)
    for f in [os.path.join(d, n) for d, _, names in os.walk(f"{scratch}/inv") for n in names if n.startswith("part-") and "inventory=" in d]:
        with open(f, "r+b") as data:  # spoil the pages: the footer alone is read
            data.seek(4)
            data.write(b"\0" * 16)
    counts = inv_src.catalog_counts(inv_src.catalog(spark, f"{scratch}/inv")).collect()
    assert sorted(c["total_count"] for c in counts) == sorted(len(v) for v in want.values())


def test_a_scan_without_columns_counts_where_footers_cannot_be_opened(spark, scratch, monkeypatch):
    stored(spark, scratch)
    want = sorted(map(tuple, inv_src.catalog(spark, f"{scratch}/inv").collect()))
    monkeypatch.setattr(inv_src, "_readable", lambda file: False)
    assert sorted(map(tuple, inv_src.catalog(spark, f"{scratch}/inv").collect())) == want


def test_a_slice_opens_only_its_files(spark, scratch):
    want = stored(spark, scratch)
    files = inv_src.read_catalog(spark, f"{scratch}/inv")
    for name, rows in want.items():
        (path,) = {r["inventory"] for r in files.collect() if (name[0] == "z") == ("=z-" in r["inventory"])}
        for start, end in ((0, 5), (3, 120), (len(rows) - 2, len(rows)), (len(rows), len(rows))):
            piece = inv_src.read_slice(spark, files, path, start, end, ["granule_id", "status"])
            got = [(r["granule_id"], r["status"]) for r in piece.orderBy("inventory_seq").collect()]
            assert got == rows[start:end]
            holding = files.filter((F.col("inventory") == path) & (F.col("first_seq") < end) & (F.col("first_seq") + F.col("rows") > start))
            assert len(piece.inputFiles()) == holding.count()


def test_an_overtaken_run_withdraws_and_takes_the_next_slice(spark, scratch, monkeypatch):
    stored(spark, scratch)
    idle = spark.createDataFrame([("j", "SUCCEEDED")], "job_id string, status string")
    args = (spark, f"{scratch}/inv", f"{scratch}/progress", idle, f"{scratch}/requests")
    jobs.create_tracking(spark, f"{scratch}/inv", f"{scratch}/progress")
    real, raced = prog.update_progress, []

    def overtaken(*a):
        if not raced:
            raced.append(True)
            jobs.run_feed(*args, 2, 10, 10, "out")  # another run takes the slice meanwhile
        return real(*a)

    monkeypatch.setattr(prog, "update_progress", overtaken)
    assert jobs.run_feed(*args, 1, 10, 10, "out") == 2
    requests = spark.read.parquet(f"{scratch}/requests")
    ids = [r["granule_id"] for r in requests.collect()]
    assert len(ids) == len(set(ids))
    first = min(r["inventory"] for r in inv_src.read_catalog(spark, f"{scratch}/inv").collect())
    taken = inv_src.read_slice(spark, inv_src.read_catalog(spark, f"{scratch}/inv"), first, 0, 20, ["granule_id", "status"])
    assert sorted(ids) == sorted(r["granule_id"] for r in taken.collect() if r["status"] == "completed")
    progress, version = prog.read_progress(spark, f"{scratch}/progress")
    assert version == 2 and max(r["submitted_count"] for r in progress.collect()) == 20


def test_external_files_and_names_that_do_not_match(spark, scratch):
    one = spark.createDataFrame([(f"g{i}", "completed") for i in range(5)], "granule_id string, status string").coalesce(1)
    one.write.parquet(f"{scratch}/x/inventory=cumulus-rds-granules-1.parquet")
    one.limit(2).coalesce(1).write.parquet(f"{scratch}/x/other")
    found = inv_src.catalog(spark, f"{scratch}/x").collect()
    assert [(r["first_seq"], r["rows"]) for r in found] == [(0, 5)]
