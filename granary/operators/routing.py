"""Job outcome classification and routing to the log, retry and failure tables; re-drive and requeue.

These are the batch forms; ``granary.streaming`` runs the same functions inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import events as ev
from granary.functions import jobs
from granary.functions import paths as pth
from granary.functions.granules import acquisition_date, platform
from granary.operators.selection import LISTED, split_first
from granary.session import scratch_path

# Fixed value: event source of the job scheduler's state changes.
BATCH_SOURCE = "aws.batch"


def is_terminal(job_queue: str, job_definition_name: str) -> Column:
    d = F.col("detail")
    return (
        (F.col("source") == BATCH_SOURCE)
        & (d.getField("jobQueue") == job_queue)
        & d.getField("jobDefinition").contains(job_definition_name)
        & d.getField("status").isin(jobs.TERMINAL_STATUSES)
    )


def terminal_events(events: DataFrame, job_queue: str, job_definition_name: str) -> DataFrame:
    """State changes of our queue and job definition that ended (FAILED / SUCCEEDED)."""
    return events.filter(is_terminal(job_queue, job_definition_name))


def classify(events: DataFrame, strict: bool = True) -> DataFrame:
    """Job facts, outcome and route of each state-change envelope.

    Output: envelope ``id``, ``granule_id``, ``attempt`` (from the container environment; the debug bucket is not
    read on this path), ``job_id``, ``job_attempts``, ``max_attempts``, ``exit_code``, ``status_reason``,
    ``job_outcome``, ``outcome`` (success / failure), ``route`` (retry / failure / none), ``job_info`` and any extra
    columns of the input (such as an arrival order).
    """
    d = F.col("detail")
    event = ev.env_to_event(d.getField("container").getField("environment"), keep_debug_bucket=False, strict=strict)
    extra = [c for c in events.columns if c not in ("version", "id", "detail-type", "source", "account", "time",
                                                     "region", "resources", "detail")]
    staged = events.select(
        "id",
        event.getField("granule_id").alias("granule_id"),
        event.getField("attempt").alias("attempt"),
        d.getField("jobId").alias("job_id"),
        jobs.job_attempts(d).alias("job_attempts"),
        jobs.max_attempts(d).alias("max_attempts"),
        jobs.exit_code(d).alias("exit_code"),
        jobs.status_reason(d).alias("status_reason"),
        jobs.job_outcome(d).alias("job_outcome"),
        d.alias("job_info"),
        *extra,
    )
    return staged.select(
        "*",
        jobs.processing_outcome("job_outcome").alias("outcome"),
        jobs.route("job_outcome", F.col("job_attempts"), F.col("max_attempts")).alias("route"),
    )


def split_named(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that name their granule and attempt, and the others."""
    named = F.col("granule_id").isNotNull() & F.col("attempt").isNotNull()
    return classified.filter(named), classified.filter(~named)


def queue_rows(classified: DataFrame, *routes: str) -> DataFrame:
    """Messages for the queue tables of some routes, in one pass: ``message_id, body, failure_type``."""
    failure_type = F.when(F.col("route") == "retry", jobs.FAILURE_TYPE_RETRYABLE).otherwise(F.lit(jobs.FAILURE_TYPE_NONRETRYABLE))
    return classified.filter(F.col("route").isin(*routes)).select(
        F.col("id").alias("message_id"),
        ev.event_to_json("granule_id", "attempt").alias("body"),
        failure_type.alias("failure_type"),
    )


def log_rows(classified: DataFrame, prefix: str = "logs", order: str | None = None) -> DataFrame:
    """Append-only log events: one row per logged attempt, with the layout columns and the object key.

    ``outcome`` here is the attempt's own outcome; the superseding rule is applied by
    ``replay.current_job_logs`` over these rows (``order`` names the arrival column).
    """
    cols = [
        "granule_id",
        "attempt",
        "job_outcome",
        "job_info",
        "outcome",
        platform("granule_id").alias("platform"),
        acquisition_date("granule_id").alias("acquisition_date"),
    ]
    if order:
        cols.append(order)
    return classified.select(*cols)


def with_log_key(logs: DataFrame, prefix: str = "logs") -> DataFrame:
    return logs.withColumn("key", pth.log_key(prefix, "outcome", "granule_id", "attempt"))


def redrive_queue(failures: DataFrame, limit: int | None = None, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Move failure-table messages to the retry table: all of them, or the first ``limit`` by message id.

    Returns ``(moved, remaining)``, together exactly the input, also when messages share an id or are equal. The cut is
    found by selection (``operators.selection``), without a sort. The selection scans the messages many times, so they are
    written once to a scratch folder, unless they are ``stored`` (come from a queue table as they are).
    """
    if limit is None:
        return failures, failures.filter(F.lit(False))
    if not stored:
        path = scratch_path(failures.sparkSession, "redrive")
        failures.write.parquet(path)
        failures = failures.sparkSession.read.schema(failures.schema).parquet(path)
    order = ["message_id", "body", "failure_type"]
    moved, remaining = split_first(failures, order, limit)
    # all rows of it; few enough to come in their order
    return (moved.orderBy(*order).limit(limit) if 0 < limit <= LISTED else moved), remaining


def redrive_logs(failure_view: DataFrame, max_attempts: int = 3, limit: int | None = None) -> DataFrame:
    """Retry-table messages for failed granules whose newest attempt is below ``max_attempts`` (attempt kept)."""
    candidates = failure_view.filter(F.col("attempt") < max_attempts)
    if limit is not None:  # the view is stored in these two columns, as the selection scans it some times
        path = scratch_path(candidates.sparkSession, "redrive")
        candidates.select("granule_id", "attempt").write.parquet(path)
        candidates, _ = split_first(candidates.sparkSession.read.parquet(path), ["granule_id"], limit)
    return candidates.select(
        "granule_id",
        "attempt",
        ev.event_to_json("granule_id", "attempt").alias("body"),
        F.lit(jobs.FAILURE_TYPE_NONRETRYABLE).alias("failure_type"),
    )


def requeue(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Retry-table messages to next-attempt events; unparseable messages go to the failure table.

    Returns ``(events, bad)``. Only the bad row is set aside (the queue service would fail its whole batch).
    """
    parsed = messages.select("*", ev.event_from_json("body").alias("_e"))
    good = parsed.filter(F.col("_e").isNotNull()).select(
        *[c for c in messages.columns if c != "body"], ev.next_attempt("_e").alias("_e")
    )
    events = good.select(
        *[c for c in messages.columns if c not in ("body", "failure_type")],
        F.col("_e.granule_id").alias("granule_id"),
        F.col("_e.attempt").alias("attempt"),
        F.col("_e.debug_bucket").alias("debug_bucket"),
    )
    bad = parsed.filter(F.col("_e").isNull()).drop("_e")
    return events, bad
