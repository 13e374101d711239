"""End-to-end jobs over storage: conversion -> tracking -> feed runs; monitor stream -> log layout -> re-drive."""

from __future__ import annotations

import os

import pytest

from pyspark.sql import functions as F

from granary.operators import routing
from granary.plans import catalog, jobs
from granary.plans import fixtures as fx
from granary.sources import inventory as inv_src
from granary.sources import joblogs
from granary.sources import progress as prog
from granary.streaming import monitor
from tests.conftest import SMALL_SF


def test_inventory_to_feed(spark, scratch):
    raw = fx.raw_inventory(spark, SMALL_SF)
    names = sorted(r.inventory for r in raw.select("inventory").distinct().collect())
    paths = []
    for name in names:
        lines = [r.value for r in raw.filter(F.col("inventory") == name).collect()]
        path = f"{scratch}/listings/{name.replace('.parquet', '.txt')}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        paths.append(path)
    jobs.convert_inventories(spark, paths, f"{scratch}/inventory")
    found = inv_src.count_rows(inv_src.discover_inventories(spark, f"{scratch}/inventory")).collect()
    assert len(found) == 3 and all("/inventory=" in r.inventory for r in found)

    idle = spark.createDataFrame([("j", "SUCCEEDED")], "job_id string, status string")
    v1 = jobs.run_feed(spark, f"{scratch}/inventory", f"{scratch}/progress", idle, f"{scratch}/requests", 1, 7, 10, "out")
    v2 = jobs.run_feed(spark, f"{scratch}/inventory", f"{scratch}/progress", idle, f"{scratch}/requests", 2, 7, 10, "out")
    assert (v1, v2) == (1, 2)
    progress, _ = prog.read_progress(spark, f"{scratch}/progress")
    first = min(names).replace(".parquet", ".txt")
    assert {r.inventory.split("inventory=")[1]: r.submitted_count for r in progress.collect()}[first] == 14
    requests = spark.read.parquet(f"{scratch}/requests")
    completed = inv_src.read_inventory(spark, f"{scratch}/inventory").filter(
        (F.col("inventory") == first) & (F.col("inventory_seq") < 14))
    assert requests.count() == completed.count() == 14  # conversion keeps completed rows only


def test_monitor_logs_and_redrive(spark, scratch):
    events_dir = f"{scratch}/incoming"
    catalog._events(spark, SMALL_SF).repartition(3).write.json(events_dir)
    sinks = monitor.MonitorSinks(f"{scratch}/log_events", f"{scratch}/retry", f"{scratch}/failure",
                                 f"{scratch}/rejects")
    stream = monitor.read_state_changes(spark, events_dir, max_files_per_trigger=1)
    q = monitor.start_monitor(stream, sinks, f"{scratch}/ckpt", catalog.MAIN_QUEUE, catalog.JOB_DEFINITION,
                              available_now=True)
    q.awaitTermination()
    jobs.materialize_current_logs(spark, sinks.log_events, f"{scratch}/logs", order="arrival", block_size=4096)
    logs = joblogs.read_job_logs(spark, f"{scratch}/logs")
    want = catalog.QUERIES["stream_current_logs"](spark, SMALL_SF)
    assert logs.count() == want.count()
    n = jobs.redrive_from_logs(spark, f"{scratch}/logs", f"{scratch}/retry_redrive", 5)
    assert n == catalog.QUERIES["redrive_logs"](spark, SMALL_SF).count()


def test_redrive_from_queue_job(spark, scratch):
    from granary.sources import queues

    failures = spark.createDataFrame([(f"m{i}", "{}", "NONRETRYABLE") for i in range(6)],
                                     "message_id string, body string, failure_type string")
    def ids(name):
        return sorted(r.message_id for r in queues.read_queue(spark, f"{scratch}/{name}").collect())

    queues.append_batch(failures, f"{scratch}/failure", "monitor", 1)
    queues.append_batch(failures.limit(2), f"{scratch}/retry", "monitor", 1)
    before = ids("retry")
    jobs.redrive_from_queue(spark, f"{scratch}/failure", f"{scratch}/retry", 1, limit=4)
    assert ids("retry") == sorted([*before, "m0", "m1", "m2", "m3"])  # the monitor's messages are still there
    assert ids("failure") == ["m4", "m5"]
    jobs.redrive_from_queue(spark, f"{scratch}/failure", f"{scratch}/retry", 2)
    assert ids("retry") == sorted([*before, *(f"m{i}" for i in range(6))]) and ids("failure") == []


def test_redrive_keeps_messages_that_share_an_id(spark):
    rows = [("m", "a", "x"), ("m", "a", "x"), ("m", "b", "x"), ("n", "c", "x")]
    df = spark.createDataFrame(rows, "message_id string, body string, failure_type string")
    moved, remaining = routing.redrive_queue(df, 2)
    assert sorted(tuple(r) for r in moved.collect()) == rows[:2]
    assert sorted(tuple(r) for r in remaining.collect()) == rows[2:]


def test_bad_lines_are_kept(spark, scratch):
    os.makedirs(f"{scratch}/listing")
    with open(f"{scratch}/listing/one.txt", "w") as fh:
        fh.write("HLS.L30.T55XYZ.2021003T010203.v2.0 2021-01-03\\ 01:02:03+00 completed t\nno listing line\n")
    jobs.convert_inventories(spark, [f"{scratch}/listing"], f"{scratch}/inv", rejects=f"{scratch}/bad")
    assert spark.read.parquet(f"{scratch}/inv").count() == 1
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/bad").collect()] == [("one.txt", "no listing line")]


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    from granary import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    monkeypatch.delenv("GRANARY_CHECKPOINT_DIR", raising=False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
