"""Facts and outcome of a job-detail document (``JOB_INFO_TYPE``), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Job outcome names, the processing outcome (log partition) names, the status-reason prefix that marks
# an infrastructure interruption, active and terminal job statuses.
SUCCESS = "SUCCESS"
FAILURE_RETRYABLE = "FAILURE_RETRYABLE"
FAILURE_NONRETRYABLE = "FAILURE_NONRETRYABLE"
OUTCOME_SUCCESS = "success"
OUTCOME_FAILURE = "failure"
RETRYABLE_REASON_PREFIX = "Host EC2"
ACTIVE_STATUSES = ["SUBMITTED", "PENDING", "RUNNABLE", "STARTING", "RUNNING"]
TERMINAL_STATUSES = ["FAILED", "SUCCEEDED"]
FAILURE_TYPE_RETRYABLE = "RETRYABLE"
FAILURE_TYPE_NONRETRYABLE = "NONRETRYABLE"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def job_attempts(detail: Column | str) -> Column:
    """Number of attempts recorded on the job (0 when the list is absent)."""
    return F.coalesce(F.cardinality(_c(detail).getField("attempts")), F.lit(0))


def max_attempts(detail: Column | str) -> Column:
    """Attempts allowed by the retry strategy (1 when there is none)."""
    return F.coalesce(_c(detail).getField("retryStrategy").getField("attempts"), F.lit(1))


def exit_code(detail: Column | str) -> Column:
    return _c(detail).getField("container").getField("exitCode")


def status_reason(detail: Column | str) -> Column:
    return F.coalesce(_c(detail).getField("statusReason"), F.lit(""))


def job_outcome(detail: Column | str) -> Column:
    """SUCCESS on exit 0; FAILURE_RETRYABLE when there is no exit code and the host went away; else NONRETRYABLE."""
    code = exit_code(detail)
    return (
        F.when(code == 0, F.lit(SUCCESS))
        .when(code.isNull() & status_reason(detail).startswith(RETRYABLE_REASON_PREFIX), F.lit(FAILURE_RETRYABLE))
        .otherwise(F.lit(FAILURE_NONRETRYABLE))
    )


def processing_outcome(job_outcome_name: Column | str) -> Column:
    """Job outcome (three values) to the log partition value (success / failure)."""
    return F.when(_c(job_outcome_name) == SUCCESS, F.lit(OUTCOME_SUCCESS)).otherwise(F.lit(OUTCOME_FAILURE))


def last_attempt(attempts: Column | str) -> Column:
    """Last element of the attempts array; null (not an error) for an empty or missing array."""
    return F.try_element_at(_c(attempts), F.lit(-1))


def millis_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp truncated to whole seconds (integer division first)."""
    m = _c(ms).cast("bigint")
    return F.timestamp_seconds(F.call_function("div", m, F.lit(1000)))


def route(job_outcome_name: Column | str, attempts: Column, max_allowed: Column) -> Column:
    """Where a job outcome goes besides the log: ``retry``, ``failure`` or ``none``.

    Retryable failures are requeued only once the job's own retries are used up; earlier ones are retried by the
    scheduler and only logged.
    """
    o = _c(job_outcome_name)
    return (
        F.when((o == FAILURE_RETRYABLE) & (attempts == max_allowed), F.lit("retry"))
        .when(o == FAILURE_NONRETRYABLE, F.lit("failure"))
        .otherwise(F.lit("none"))
    )
