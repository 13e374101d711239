"""Reports, views and storage round trips (log JSON, snapshot manifests, queue tables, CSV)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from granary.operators import replay, reporting, routing
from granary.sources import joblogs, queues, snapshot

G1 = "HLS.S30.T63XYZ.2023051T070809.v2.0"
G2 = "HLS.L30.T62XYZ.2024061T050607.v2.0"


def snapshot_rows():
    def key(o, p, d, g, a):
        return f"logs/outcome={o}/platform={p}/acquisition_date={d}/granule_id={g}/attempt={a}.json"

    t = dt.datetime(2025, 6, 1)
    rows = []
    for d in ("2025-06-01-01-00", "2025-06-02-01-00"):
        rows += [
            ("b", key("failure", "S30", "2023-02-20", G1, 0), "v", True, False, t, d),
            ("b", key("failure", "L30", "2024-03-01", G2, 0), "v", True, False, t, d),
            ("b", "logs/manifest.json", "v", True, False, t, d),
        ]
    # newest listing: G1 succeeded at attempt 1 (failure copied over), G2 has an old version and a delete marker
    rows += [
        ("b", key("success", "S30", "2023-02-20", G1, 0), "v", True, False, t, "2025-06-03-01-00"),
        ("b", key("success", "S30", "2023-02-20", G1, 1), "v", True, False, t, "2025-06-03-01-00"),
        ("b", key("failure", "L30", "2024-03-01", G2, 0), "v", False, False, t, "2025-06-03-01-00"),
        ("b", key("failure", "L30", "2024-03-01", G2, 1), "v", True, False, t, "2025-06-03-01-00"),
        ("b", key("failure", "L30", "2024-03-01", G2, 2), "v", True, True, t, "2025-06-03-01-00"),
    ]
    return rows


SNAP_SCHEMA = ("bucket string, key string, version_id string, is_latest boolean, is_delete_marker boolean, "
               "last_modified_date timestamp, dt string")


def test_view_and_status_report(spark, scratch):
    snapshot.write_snapshot(spark.createDataFrame(snapshot_rows(), SNAP_SCHEMA), f"{scratch}/snap")
    snap = snapshot.read_snapshot(spark, f"{scratch}/snap")
    view = reporting.processing_events_view(snap)
    rows = sorted((r.granule_id, r.outcome, r.attempt) for r in view.collect())
    assert rows == [(G2, "failure", 1), (G1, "success", 0), (G1, "success", 1)]
    status = {(r.platform, r.outcome): r.granule_count for r in reporting.overall_status(view).collect()}
    assert status == {("S30", "success"): 1, ("L30", "failure"): 1}
    report = reporting.progress_by_year(view).collect()
    assert [(r.year.year, r.platform, r.outcome) for r in report] == [(2024, "L30", "failure"), (2023, "S30", "success")]
    grid = reporting.report_grid(reporting.progress_by_year(view))
    assert grid.count() == 2 * 2 * 2
    pivot = {r.year.year: (r.L30, r.S30) for r in reporting.report_pivot(grid).collect()}
    assert pivot == {2023: (0, 1), 2024: (0, 0)}
    queues.write_report_csv(reporting.progress_by_year(view), f"{scratch}/report.csv")
    csv = [f for f in os.listdir(f"{scratch}/report.csv") if f.endswith(".csv")]
    assert len(csv) == 1
    with open(f"{scratch}/report.csv/{csv[0]}") as fh:
        assert fh.readline().strip() == "platform,outcome,year,granule_count"


def test_snapshot_manifests(spark, scratch):
    df = spark.createDataFrame(snapshot_rows(), SNAP_SCHEMA)
    for d in ("2025-06-01-01-00", "2025-06-03-01-00"):
        data = f"{scratch}/data/{d}"
        df.filter(F.col("dt") == d).drop("dt").write.parquet(data)
        files = [f"{data}/{f}" for f in os.listdir(data) if f.endswith(".parquet")]
        os.makedirs(f"{scratch}/manifests/dt={d}")
        with open(f"{scratch}/manifests/dt={d}/symlink.txt", "w") as fh:
            fh.write("\n".join(files) + "\n")
    newest = snapshot.read_snapshot_manifests(spark, f"{scratch}/manifests")
    assert {r.dt for r in newest.collect()} == {"2025-06-03-01-00"}
    assert newest.count() == 5


def test_job_log_sink_and_failure_view(spark, scratch):
    def info(code, started):
        return F.struct(
            F.array(F.struct(
                F.struct(F.lit(code).cast("int").alias("exitCode"), F.lit("stream").alias("logStreamName")).alias("container"),
                F.lit(started).cast("bigint").alias("startedAt"), F.lit(started + 1500).cast("bigint").alias("stoppedAt"),
                F.lit("why").alias("statusReason"))).alias("attempts"))

    base = spark.createDataFrame([(G1, 0, "FAILURE_RETRYABLE", 1), (G1, 1, "FAILURE_NONRETRYABLE", 2),
                                  (G2, 0, "SUCCESS", 1)], "granule_id string, attempt int, job_outcome string, seq long")
    events = base.withColumn("job_info", F.when(F.col("attempt") == 0, info(None, 1_600_000_000_111))
                             .otherwise(info(1, 1_600_000_300_222)))
    current = replay.current_job_logs(events)
    layout = routing.log_rows(current)
    joblogs.write_job_logs(layout, f"{scratch}/logs")
    logs = joblogs.read_job_logs(spark, f"{scratch}/logs")
    assert logs.filter("outcome = 'failure'").count() == 2
    view = reporting.failures_view(logs).collect()
    assert len(view) == 1
    r = view[0]
    assert (r.granule_id, r.attempt, r.exit_code, r.platform) == (G1, 1, 1, "S30")
    assert r.started_at == dt.datetime(2020, 9, 13, 12, 31, 40)  # whole seconds of the last try
    assert r.stopped_at == dt.datetime(2020, 9, 13, 12, 31, 41)
    assert r.acquisition_date == dt.datetime(2023, 2, 20)
    assert r.key.startswith("file:") and "outcome=failure" in r.key


def test_queue_batches_are_idempotent(spark, scratch):
    df = spark.createDataFrame([("m1", "{}", "RETRYABLE")], "message_id string, body string, failure_type string")
    queues.append_batch(df, f"{scratch}/q", "a", 0)
    queues.append_batch(df, f"{scratch}/q", "a", 0)  # replayed batch overwrites itself
    queues.append_batch(df, f"{scratch}/q", "a", 1)
    queues.append_batch(df, f"{scratch}/q", "b", 1)  # another producer's batch of the same number
    assert queues.read_queue(spark, f"{scratch}/q").count() == 3
    assert queues.batches(spark, f"{scratch}/q") == [("a", 0), ("a", 1), ("b", 1)]
    assert queues.batches(spark, f"{scratch}/none") == [] and queues.read_batches(spark, f"{scratch}/none", []).count() == 0


def test_rewritten_log_drops_superseded_failures(spark, scratch):
    def rewrite(events):
        df = spark.createDataFrame(events, "granule_id string, attempt int, job_outcome string, seq long")
        df = df.withColumn("job_info", F.struct(F.lit("q").alias("jobQueue")))
        return joblogs.rewrite_job_logs(routing.log_rows(replay.current_job_logs(df)), f"{scratch}/logs")

    def stored():
        return {(r.outcome, r.attempt) for r in joblogs.read_job_logs(spark, f"{scratch}/logs").collect()}

    events = [(G1, 0, "FAILURE_RETRYABLE", 1)]
    assert rewrite(events) == 0 and stored() == {("failure", 0)}
    os.makedirs(f"{scratch}/logs/version=1/outcome=failure")  # a writer that was lost
    assert stored() == {("failure", 0)}
    assert rewrite([*events, (G1, 1, "SUCCESS", 2)]) == 1
    assert stored() == {("success", 0), ("success", 1)}
    assert rewrite(events) == 2 and joblogs.versions(spark, f"{scratch}/logs") == [1, 2]


def test_old_listings_are_dropped(spark, scratch):
    from granary.plans import jobs

    assert jobs.drop_old_listings(spark, f"{scratch}/snap") == []
    snapshot.write_snapshot(spark.createDataFrame(snapshot_rows(), SNAP_SCHEMA), f"{scratch}/snap")
    assert jobs.drop_old_listings(spark, f"{scratch}/snap", keep_days=1) == ["2025-06-01-01-00"]
    assert {r.dt for r in snapshot.read_snapshot(spark, f"{scratch}/snap").collect()} == {"2025-06-02-01-00", "2025-06-03-01-00"}


def test_retention_keeps_recent_rows(spark):
    now = dt.datetime(2025, 6, 30)
    df = spark.createDataFrame([(1, now), (2, now - dt.timedelta(days=14)), (3, now - dt.timedelta(days=15))],
                               "id int, ts timestamp")
    kept = reporting.retention(df, "ts", 14, as_of=F.lit(now)).collect()
    assert sorted(r.id for r in kept) == [1, 2]


def test_parquet_log_layout_prunes_nested_fields(spark, scratch):
    base = spark.createDataFrame([(G1, 0, "FAILURE_NONRETRYABLE", 1)],
                                 "granule_id string, attempt int, job_outcome string, seq long")
    tries = F.array(F.struct(F.struct(F.lit(1).alias("exitCode")).alias("container"),
                             F.lit(1_600_000_300_222).cast("bigint").alias("startedAt")))
    events = base.withColumn("job_info", F.struct(tries.alias("attempts"), F.lit("q").alias("jobQueue")))
    layout = routing.log_rows(replay.current_job_logs(events))
    joblogs.write_job_logs(layout, f"{scratch}/plogs", fmt="parquet")
    logs = joblogs.read_job_logs(spark, f"{scratch}/plogs", fmt="parquet")
    view = reporting.failures_view(logs)
    assert view.first().exit_code == 1
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        view.explain("formatted")
    read_schema = [line for line in buf.getvalue().splitlines() if line.startswith("ReadSchema")][0]
    assert "jobQueue" not in read_schema and "attempts" in read_schema


def test_progress_report_job_and_chart_data(spark, scratch):
    from granary.plans import jobs

    snapshot.write_snapshot(spark.createDataFrame(snapshot_rows(), SNAP_SCHEMA), f"{scratch}/snap")
    report = jobs.progress_report(spark, f"{scratch}/snap", f"{scratch}/report.csv")
    assert report.count() == 2
    assert any(f.endswith(".csv") for f in os.listdir(f"{scratch}/report.csv"))
    chart = jobs.chart_data(report).collect()
    assert [(r.year.year, r.L30, r.S30) for r in chart] == [(2023, 0, 1), (2024, 0, 0)]
