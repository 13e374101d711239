"""End-to-end jobs a user runs: storage in, storage out. Each is a thin composition of the operators."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.granules import acquisition_date
from granary.operators import feed, inventory, replay, reporting, routing
from granary.session import configure, delete_folder, list_folder, scratch_path
from granary.sources import inventory as inv_src
from granary.sources import commits, joblogs, logtable, queues, snapshot
from granary.sources import progress as prog


def convert_inventories(spark: SparkSession, listings: list[str], destination: str, rejects: str | None = None) -> None:
    """Listing text files to newest-first Parquet tables (one per listing), written once, with their catalogue of files.

    A bad line fails the job, unless a ``rejects`` folder takes the bad lines (``inventory, value``). Then the listings are
    read and parsed once, into a staged table that both outputs come from.
    """
    configure(spark)
    lines = inv_src.read_inventory_text(spark, listings)
    if rejects is None:
        inv_src.write_ordered(inventory.completed_rows(lines), destination, inventory.inventory_order())
        return
    staged = scratch_path(spark, "parsed-listings")
    parsed = inventory.parse_inventory(lines, strict=False)
    parsed.withColumn("value", F.when(~F.col("parse_ok"), F.col("value"))).write.partitionBy("parse_ok").parquet(staged)
    good, bad = inventory.quarantine(spark.read.schema(parsed.schema).parquet(staged))
    bad.write.mode("overwrite").parquet(rejects)
    inv_src.write_ordered(inventory.completed(good), destination, inventory.inventory_order())
    delete_folder(spark, staged)


def create_tracking(spark: SparkSession, inventory_path: str, progress_path: str) -> int:
    """Write fresh progress records ``(inventory, 0, total)`` of the inventories in the catalogue (made now if there is none),
    keyed by the inventory's path; fails if progress exists already."""
    configure(spark)
    return prog.create_progress(spark, progress_path, inv_src.catalog_counts(inv_src.read_catalog(spark, inventory_path)))


def run_feed(
    spark: SparkSession,
    inventory_path: str,
    progress_path: str,
    summaries: DataFrame,
    requests_path: str,
    run_id: int,
    n: int,
    max_active_jobs: int,
    output_bucket: str,
    debug_bucket: str | None = None,
) -> int | None:
    """One feed run: gate, next slice, work requests, progress. Returns the stored progress version.

    The slice's files come from the catalogue, so no other is listed or opened. Requests are written (keyed by ``run_id``)
    before progress moves, so a crash in between re-submits the slice (at least once). A run that another one overtook
    withdraws its requests and takes the next slice. In debug mode the progress is not stored.
    """
    configure(spark)
    files = inv_src.read_catalog(spark, inventory_path)
    for _ in range(commits.TRIES):
        try:
            progress, version = prog.read_progress(spark, progress_path)
        except prog.ProgressNotFoundError:
            try:
                create_tracking(spark, inventory_path, progress_path)
            except prog.ProgressConflictError:  # another run was first
                pass
            progress, version = prog.read_progress(spark, progress_path)
        if not feed.gate_open(summaries, max_active_jobs):
            return version
        chosen = feed.next_slice(progress, n)
        if chosen is None:
            return version
        rows = inv_src.read_slice(spark, files, chosen.inventory, chosen.start, chosen.end, ["granule_id", "status"])
        events = feed.slice_rows(rows, chosen).select("granule_id", F.lit(0).alias("attempt"))
        queues.append_batch(feed.work_requests(events, output_bucket, debug_bucket), requests_path, "feed", run_id)
        if debug_bucket:  # debug runs never count as submitted
            return version
        try:
            return prog.update_progress(spark, progress_path, feed.advance(progress, chosen), version)
        except prog.ProgressConflictError:
            queues.drop_batches(spark, requests_path, [("feed", run_id)])
    raise prog.ProgressConflictError(f"Progress at {progress_path} changed {commits.TRIES} times")


def materialize_current_logs(spark: SparkSession, events_path: str, logs_path: str, order: str = "arrival",
                             block_size: int = 86_400_000) -> None:
    """Rewrite the log layout (``outcome=/platform=/acquisition_date=``) from the append-only event table.

    The rewrite is a new version of the whole log, so failures that were superseded since are gone from it. It is made in
    parts of whole days (an ``acquisition_date`` of the events must be that of their granule, as ``routing.log_rows`` gives it).
    """
    configure(spark)
    joblogs.rewrite_job_logs([routing.log_rows(part) for part in current_parts(spark, events_path, order, block_size)], logs_path)


def current_parts(spark: SparkSession, events_path: str, order: str = "arrival", block_size: int = 86_400_000) -> list[DataFrame]:
    """Current log objects of an event table, in parts of whole days."""
    events = spark.read.parquet(events_path).drop("producer", "batch_id", "platform")
    if "acquisition_date" not in events.columns:
        events = events.withColumn("acquisition_date", acquisition_date("granule_id"))
    tie = "id" if "id" in events.columns else None
    return replay.current_in_parts(events, "acquisition_date", order=order, block_size=block_size, tie=tie)


def compact_logs(spark: SparkSession, events_path: str, logs_path: str, block_size: int = 86_400_000, keep: int | None = 2) -> list[int]:
    """Put the event batches that the log at ``logs_path`` lacks into it, producer by producer and in order.

    Each compaction rewrites only the days that its batch touches; returns the versions made. In the end what only older
    manifests than the last ``keep`` name is deleted (``None``: nothing).
    """
    configure(spark)
    made = []
    for producer, batch_id in queues.batches(spark, events_path):
        if batch_id <= logtable.last_batch(spark, logs_path, producer):
            continue
        events = spark.read.parquet(queues.batch_folder(events_path, producer, batch_id))
        made.append(logtable.compact(events, logs_path, producer, batch_id, block_size))
    if made and keep is not None:
        logtable.vacuum(spark, logs_path, keep)
    return made


def progress_report(spark: SparkSession, snapshot_location: str, csv_path: str | None = None) -> DataFrame:
    """Yearly progress report over the newest storage listing; optionally written as one CSV."""
    configure(spark)
    report = reporting.progress_by_year(reporting.processing_events_view(snapshot.read_snapshot(spark, snapshot_location)))
    if csv_path:
        queues.write_report_csv(report, csv_path)
    return report


def chart_data(report: DataFrame) -> DataFrame:
    """Dense, success-only, per-platform columns of a yearly report (what the chart plots)."""
    return reporting.report_pivot(reporting.report_grid(report)).orderBy("year")


def redrive_from_logs(spark: SparkSession, logs_path: str, retry_path: str, run_id: int, max_attempts: int = 3,
                      limit: int | None = None) -> int:
    """Failure view rows below the attempt cap to the retry table (attempt unchanged); returns rows written."""
    configure(spark)
    compacted = logtable.is_compacted(spark, logs_path)
    logs = logtable.read(spark, logs_path, "failure") if compacted else joblogs.read_job_logs(spark, logs_path)
    view = reporting.failures_view(logs.filter(F.col("outcome") == "failure"))
    msgs = routing.redrive_logs(view, max_attempts, limit).select(
        F.concat(F.lit(f"redrive-{run_id}-"), F.col("granule_id")).alias("message_id"), "body", "failure_type"
    )
    queues.append_batch(msgs, retry_path, "redrive-logs", run_id)
    return queues.read_batches(spark, retry_path, [("redrive-logs", run_id)]).count()


def redrive_from_queue(spark: SparkSession, failure_path: str, retry_path: str, run_id: int, limit: int | None = None) -> None:
    """Move failure-table messages (all, or the first ``limit``) to the retry table.

    The batches that are there now are read; the moved messages are written to the retry table, then the rest as one
    batch of the failure table, and then the batches that were read are dropped, so the failure table shrinks by what
    was moved. Batches that producers add meanwhile are left alone. A run that was cut short is repeated with its
    ``run_id``: it reads the same batches again and replaces its own (messages are moved at least once).
    """
    configure(spark)
    own = ("redrive-rest", run_id)
    before = [b for b in queues.batches(spark, failure_path) if b != own]
    failures = queues.read_batches(spark, failure_path, before).drop("producer", "batch_id")
    moved, remaining = routing.redrive_queue(failures, limit, stored=True)
    queues.append_batch(moved, retry_path, "redrive-queue", run_id)
    queues.append_batch(remaining, failure_path, *own)
    queues.drop_batches(spark, failure_path, before)


def expire_queue(spark: SparkSession, path: str, keep_days: int = 14, now_ms: int | None = None) -> list[tuple[str, int]]:
    """Retention of a queue table: drop the batches older than ``keep_days``; returns their producers and numbers."""
    now = int(time.time() * 1000) if now_ms is None else now_ms
    return queues.expire_batches(spark, path, now - keep_days * 86_400_000)


def drop_old_listings(spark: SparkSession, location: str, keep_days: int = 14) -> list[str]:
    """Retention of a ``dt=``-partitioned listing: drop partitions older than ``keep_days`` before the newest one."""
    days = sorted(n.removeprefix("dt=") for n in list_folder(spark, location) if n.startswith("dt="))
    if not days:
        return []
    oldest = dt.date.fromisoformat(days[-1][:10]) - dt.timedelta(days=keep_days)
    dropped = [d for d in days if dt.date.fromisoformat(d[:10]) < oldest]
    for day in dropped:
        delete_folder(spark, f"{location.rstrip('/')}/dt={day}")
    return dropped
