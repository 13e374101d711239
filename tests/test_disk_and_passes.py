"""Bounded disk and passes: compressed documents, micro-batches of bounded size, one computation of what a re-drive scans."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from granary.operators import replay, routing
from granary.plans import catalog
from granary.plans.fixtures import MAIN_QUEUE
from granary.sources import joblogs, logtable, queues
from granary.streaming import monitor
from tests.conftest import SMALL_SF


def _files(path: str) -> list[str]:
    return [f for _, _, names in os.walk(path.removeprefix("file:")) for f in names if f.startswith("part-")]


def _logged(spark):
    rows = routing.log_rows(catalog._routed(spark, SMALL_SF), order="seq").withColumnRenamed("seq", "arrival")
    return rows.withColumn("id", F.col("job_info.jobId")).filter("granule_id like 'HLS.L30.T01ABC.199501%'")


def test_log_documents_are_stored_compressed(spark, scratch):
    events = _logged(spark)
    current = replay.current_job_logs(events.drop("platform", "acquisition_date"), order="arrival", tie="id").cache()
    joblogs.rewrite_job_logs(catalog._by_month(routing.log_rows(current)), f"{scratch}/logs")
    logtable.compact(events, f"{scratch}/table", "history", 0)
    for path in (f"{scratch}/logs", f"{scratch}/table/data"):
        assert _files(path) and all(f.endswith(".json.gz") for f in _files(path))
    columns = ["granule_id", "outcome", "attempt", "job_outcome", "job_info.jobId", "job_info.startedAt", "job_info.statusReason"]
    expected = sorted(map(str, current.select(*columns).collect()))
    assert sorted(map(str, joblogs.read_job_logs(spark, f"{scratch}/logs").select(*columns).collect())) == expected
    assert sorted(map(str, logtable.read(spark, f"{scratch}/table").select(*columns).collect())) == expected


def test_a_backlog_is_taken_in_pieces(spark, scratch):
    events = catalog._events(spark, SMALL_SF)
    events.repartition(6).write.option("compression", "gzip").json(f"{scratch}/in")
    largest = max(os.path.getsize(f"{scratch}/in/{f}") for f in _files(f"{scratch}/in"))
    sinks = monitor.MonitorSinks(*(f"{scratch}/{n}" for n in ("log", "retry", "failure", "rejects")))
    stream = monitor.read_state_changes(spark, f"{scratch}/in", max_bytes_per_trigger=largest * 2 + 1)
    monitor.start_monitor(stream, sinks, f"{scratch}/ckpt", MAIN_QUEUE, catalog.JOB_DEFINITION, available_now=True).awaitTermination()
    assert len(queues.batches(spark, sinks.log_events)) >= 3
    routed = catalog._routed(spark, SMALL_SF)
    assert sorted(r[0] for r in spark.read.parquet(sinks.log_events).select("id").collect()) == sorted(r[0] for r in routed.select("id").collect())
    assert queues.read_queue(spark, sinks.failure).count() == routed.filter("route = 'failure'").count()


def test_a_cut_document_is_rejected_whatever_was_read_of_it(spark, scratch):
    document = catalog._events(spark, SMALL_SF).filter("source = 'aws.batch'").select(F.to_json(F.struct("*")).alias("value")).first()[0]
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.json", "w") as out:
        out.write(f"{document[:-1]}, \nno document\n")
    sinks = monitor.MonitorSinks(*(f"{scratch}/{n}" for n in ("log", "retry", "failure", "rejects")))
    stream = monitor.read_state_changes(spark, f"{scratch}/in")
    monitor.start_monitor(stream, sinks, f"{scratch}/ckpt", MAIN_QUEUE, catalog.JOB_DEFINITION, available_now=True).awaitTermination()
    rejects = spark.read.schema("reason string, document string").parquet(sinks.rejects).collect()
    assert sorted(r["document"] for r in rejects) == sorted([f"{document[:-1]}, ", "no document"])
    assert {r["reason"] for r in rejects} == {"no JSON document"} and spark.read.parquet(sinks.log_events).count() == 0


def _counted(spark, frame):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return frame.mapInArrow(count, frame.schema), seen


def test_a_redrive_computes_its_messages_once(spark):
    rows = spark.range(300).select(
        F.format_string("m-%d", F.col("id") % 40).alias("message_id"), F.lit("b").alias("body"), F.lit("NONRETRYABLE").alias("failure_type")
    )
    messages, seen = _counted(spark, rows)
    moved, remaining = routing.redrive_queue(messages, 100)
    first, rest = ([tuple(r) for r in df.collect()] for df in (moved, remaining))
    assert sorted(first + rest) == sorted(map(tuple, rows.collect())) and sorted(first) == sorted(map(tuple, rows.collect()))[:100]
    assert seen.value == 300


def test_messages_of_both_routes_in_one_pass(spark):
    routed = catalog._routed(spark, SMALL_SF)
    both = routing.queue_rows(routed, "retry", "failure")
    apart = routing.queue_rows(routed, "retry").unionByName(routing.queue_rows(routed, "failure"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, apart.collect()))
    plan = [d._jdf.queryExecution().optimizedPlan().toString().count("lineitem") or d._jdf.queryExecution().optimizedPlan().toString().count("l_shipdate") for d in (both, apart)]
    assert plan[0] < plan[1]
