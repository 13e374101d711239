"""Status reports over the outcome log: latest attempt per granule, counts, failure detail, dense grid and pivot.

Every aggregate here is partial (map-side combined), so a hot granule or a hot platform costs one row per map task in
the shuffle, not one row per log object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import jobs, paths
from granary.functions.jobs import OUTCOME_FAILURE, OUTCOME_SUCCESS
from granary.functions.keys import HASH_COL, key_hash

# The platforms and outcomes every dense report shows.
PLATFORMS = ["L30", "S30"]
OUTCOMES = ["success", "failure"]

MAX_ARRIVAL = 1 << 44


def current_snapshot(snapshot: DataFrame) -> DataFrame:
    """Rows of the newest listing (``dt = max(dt)``) that are live object versions.

    The newest ``dt`` is an uncorrelated scalar subquery, so on a ``dt``-partitioned listing Spark prunes the other
    partitions at run time instead of scanning every day kept.
    """
    newest = snapshot.select(F.max("dt")).scalar()
    return snapshot.filter((F.col("dt") == newest) & F.col("is_latest") & ~F.col("is_delete_marker"))


def processing_events_view(snapshot: DataFrame) -> DataFrame:
    """One row per current log object of the newest listing, with its key split into columns (null on a miss)."""
    live = current_snapshot(snapshot)
    return live.select(*paths.view_columns("key"), "last_modified_date", "key")


def latest_attempts(logs: DataFrame, with_year: bool = True) -> DataFrame:
    """Per granule, the outcome of its newest attempt (success wins a tie on the attempt number).

    Only the outcome is needed, and rows tied on ``(attempt, is_success)`` carry the same outcome, so the pick is the
    parity of ``max(2 * attempt + is_success)``: a fixed-width maximum instead of a ``max_by`` over a struct.
    """
    packed = F.col("attempt").cast("bigint") * 2 + (F.col("outcome") == OUTCOME_SUCCESS).cast("bigint")
    aggs = [F.max(packed).alias("_p"), F.min("platform").alias("platform")]
    if with_year:
        aggs.append(F.date_trunc("year", F.min("acquisition_date")).alias("year"))
    latest = logs.groupBy(key_hash("granule_id").alias(HASH_COL), "granule_id").agg(*aggs)
    outcome = F.when(F.pmod("_p", F.lit(2)) == 1, F.lit(OUTCOME_SUCCESS)).when(
        F.col("_p").isNotNull(), F.lit(OUTCOME_FAILURE)
    )
    cols = ["granule_id", outcome.alias("outcome"), "platform"] + (["year"] if with_year else [])
    return latest.select(*cols)


def latest_from_events(
    events: DataFrame,
    key: str = "granule_id",
    order: str = "seq",
    attempt: str = "attempt",
    job_outcome: str = "job_outcome",
    with_year: bool = True,
) -> DataFrame:
    """Latest outcome per granule straight from the attempt history, without building the log state.

    An attempt ends up under ``success`` exactly when it arrived no later than the granule's last success, so the
    newest ``(attempt, is_success)`` over the current logs is ``max(2 * attempt + [order <= last_success])`` over the
    events. Equal to ``latest_attempts(replay.current_job_logs(events))``.

    One partial hash aggregate: the newest attempt with its smallest arrival, and the last success; the granule stands at
    success when that arrival is no later. A hot granule is combined map-side, nothing is joined or windowed. Attempt
    and arrival share one long, so the aggregate stays hash-based: arrivals are below ``MAX_ARRIVAL`` (beyond the year
    2500 in milliseconds), attempts below 2^19; what does not fit fails with an overflow. ``platform`` is part of the grouping key: in the log layout it
    is derived from the granule ID, so it is a function of the key (and a string aggregate would force a sort).
    """
    h = HASH_COL
    o = F.col(order).cast("bigint")
    newest = F.col(attempt).cast("bigint") * MAX_ARRIVAL + (MAX_ARRIVAL - 1 - o)
    aggs = [F.max(newest).alias("_p"), F.max(F.when(F.col(job_outcome) == "SUCCESS", o)).alias("_last")]
    if with_year:
        aggs.append(F.date_trunc("year", F.min("acquisition_date")).alias("year"))
    latest = events.withColumn(h, key_hash(key)).groupBy(h, key, "platform").agg(*aggs)
    arrival = MAX_ARRIVAL - 1 - F.pmod("_p", F.lit(MAX_ARRIVAL))
    outcome = F.when(arrival <= F.col("_last"), F.lit(OUTCOME_SUCCESS)).when(F.col("_p").isNotNull(), F.lit(OUTCOME_FAILURE))
    cols = [key, outcome.alias("outcome"), "platform"] + (["year"] if with_year else [])
    return latest.select(*cols)


def status_counts(latest: DataFrame) -> DataFrame:
    return latest.groupBy("platform", "outcome").agg(F.count(F.lit(1)).alias("granule_count"))


def yearly_counts(latest: DataFrame) -> DataFrame:
    report = latest.groupBy("platform", "outcome", "year").agg(F.count(F.lit(1)).alias("granule_count"))
    return report.orderBy(F.col("year").desc(), F.col("platform").asc(), F.col("outcome").desc())


def overall_status(logs: DataFrame) -> DataFrame:
    """Granule count per platform and latest outcome, over log objects (the listing view or the log state)."""
    return status_counts(latest_attempts(logs, with_year=False))


def progress_by_year(logs: DataFrame) -> DataFrame:
    """Granule count per platform, latest outcome and acquisition year; newest year first."""
    return yearly_counts(latest_attempts(logs))


def overall_status_from_events(events: DataFrame, order: str = "seq") -> DataFrame:
    return status_counts(latest_from_events(events, order=order, with_year=False))


def progress_by_year_from_events(events: DataFrame, order: str = "seq") -> DataFrame:
    return yearly_counts(latest_from_events(events, order=order))


def report_grid(report: DataFrame) -> DataFrame:
    """Every (year, platform, outcome) from the first to the last report year; counts are null where missing.

    The grid is built from the report's year bounds by ``sequence``/``explode`` (years x 2 x 2 rows) and the report,
    which has at most that many rows, is joined to it; both sides are bounded by the number of years.
    """
    bounds = report.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    grid = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 year"))).alias("year")
    ).select(
        "year",
        F.explode(F.array(*[F.lit(p) for p in PLATFORMS])).alias("platform"),
    ).select(
        "year", "platform", F.explode(F.array(*[F.lit(o) for o in OUTCOMES])).alias("outcome")
    )
    return grid.join(report, ["year", "platform", "outcome"], "left").select(
        "year", "platform", "outcome", "granule_count"
    )


def report_pivot(grid: DataFrame) -> DataFrame:
    """Success counts per year with one column per platform (the chart's data); 0 where the report has none."""
    success = grid.filter(F.col("outcome") == OUTCOME_SUCCESS)
    return success.groupBy("year").pivot("platform", PLATFORMS).agg(F.coalesce(F.sum("granule_count"), F.lit(0)))


def year_bounds(report: DataFrame) -> DataFrame:
    return report.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def failures_view(job_logs: DataFrame) -> DataFrame:
    """Newest failed attempt per granule, with the last try's exit code, times, reason and log stream.

    ``job_logs`` has the log layout columns (``outcome, platform, acquisition_date`` as partition values,
    ``granule_id, attempt, job_info`` and the object ``key``). Only the last try's five values travel; a ranked window keeps
    one row per granule, first within each task and then of them all. The partition filter on ``outcome`` prunes the success
    half of the log.
    """
    last_try = jobs.last_attempt(F.col("job_info").getField("attempts"))
    failed = job_logs.filter(F.col("outcome") == OUTCOME_FAILURE).select(
        key_hash("granule_id").alias(HASH_COL), "granule_id", "attempt", "platform", F.col("acquisition_date").alias("_acq"), "key", last_try.alias("_t")
    )
    newest = failed.select(
        HASH_COL,
        "granule_id",
        "platform",
        "_acq",
        "attempt",
        F.col("_t.container.exitCode").alias("exit_code"),
        F.col("_t.startedAt").alias("started"),
        F.col("_t.stoppedAt").alias("stopped"),
        F.col("_t.statusReason").alias("reason"),
        F.col("_t.container.logStreamName").alias("stream"),
        "key",
    )
    latest = Window.partitionBy(HASH_COL, "granule_id").orderBy(F.col("attempt").desc())
    picked = newest.withColumn("_n", F.row_number().over(latest)).filter(F.col("_n") <= 1)
    return picked.select(
        F.lit(OUTCOME_FAILURE).alias("outcome"),
        "platform",
        F.to_timestamp(F.col("_acq"), "yyyy-MM-dd").alias("acquisition_date"),
        "granule_id",
        F.col("attempt").alias("attempt"),
        F.col("exit_code").alias("exit_code"),
        jobs.millis_to_timestamp(F.col("started")).alias("started_at"),
        jobs.millis_to_timestamp(F.col("stopped")).alias("stopped_at"),
        F.col("reason").alias("status_reason"),
        F.col("stream").alias("logstream_name"),
        F.col("key").alias("key"),
    )


def retention(df: DataFrame, ts_col: str, days: int = 14, as_of: Column | None = None) -> DataFrame:
    """Keep rows no older than ``days`` before ``as_of`` (default: now)."""
    ref = as_of if as_of is not None else F.current_timestamp()
    return df.filter(F.col(ts_col) >= ref - F.make_interval(days=F.lit(days)))
