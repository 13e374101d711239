"""Processing events as columns: environment pairs, JSON bodies, next attempt and work-request rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.schemas import PROCESSING_EVENT_SCHEMA

# Environment variable names carried by a processing job.
ENV_GRANULE_ID = "GRANULE_ID"
ENV_ATTEMPT = "ATTEMPT"
ENV_DEBUG_BUCKET = "DEBUG_BUCKET"
ENV_OUTPUT_BUCKET = "OUTPUT_BUCKET"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _pair(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))


def event_to_env(granule_id: Column | str, attempt: Column | str, debug_bucket: Column | str | None = None) -> Column:
    """``[{name, value}]`` with ``DEBUG_BUCKET`` only when it is set (non-null, non-empty)."""
    pairs = [_pair(ENV_GRANULE_ID, _c(granule_id)), _pair(ENV_ATTEMPT, _c(attempt).cast("string"))]
    if debug_bucket is None:
        return F.array(*pairs)
    debug = _c(debug_bucket)
    with_debug = F.array(*pairs, _pair(ENV_DEBUG_BUCKET, debug))
    return F.when(F.coalesce(debug, F.lit("")) != "", with_debug).otherwise(F.array(*pairs))


def env_value(env: Column | str, name: str) -> Column:
    """Value of ``name`` in an env array; the last entry wins on duplicate names, null if absent."""
    return F.try_element_at(F.filter(_c(env), lambda e: e["name"] == F.lit(name)), F.lit(-1)).getField("value")


def _required(value: Column, name: str) -> Column:
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.lit(f"Missing environment variable {name} in job definition"))
    )


def env_to_event(env: Column | str, keep_debug_bucket: bool = True, strict: bool = True) -> Column:
    """Rebuild ``struct(granule_id, attempt, debug_bucket)`` from env pairs.

    ``keep_debug_bucket=False`` mirrors the job path, which only reads the granule and attempt variables.
    ``strict`` fails on a missing variable; otherwise the field is null.
    """
    gid = env_value(env, ENV_GRANULE_ID)
    attempt = env_value(env, ENV_ATTEMPT)
    if strict:
        gid = _required(gid, ENV_GRANULE_ID)
        attempt = _required(attempt, ENV_ATTEMPT)
    debug = env_value(env, ENV_DEBUG_BUCKET) if keep_debug_bucket else F.lit(None).cast("string")
    return F.struct(gid.alias("granule_id"), attempt.cast("int").alias("attempt"), debug.alias("debug_bucket"))


def event_to_json(granule_id: Column | str, attempt: Column | str, debug_bucket: Column | str | None = None) -> Column:
    """JSON body with all three keys (``debug_bucket`` written as null when unset)."""
    debug = F.lit(None).cast("string") if debug_bucket is None else _c(debug_bucket)
    return F.to_json(
        F.struct(_c(granule_id).alias("granule_id"), _c(attempt).cast("int").alias("attempt"), debug.alias("debug_bucket")),
        {"ignoreNullFields": "false"},
    )


def event_from_json(body: Column | str) -> Column:
    """Parse a message body; null when the body is not a JSON object with a granule ID and an attempt."""
    parsed = F.from_json(_c(body), PROCESSING_EVENT_SCHEMA)
    return F.when(parsed.getField("granule_id").isNotNull() & parsed.getField("attempt").isNotNull(), parsed)


def next_attempt(event: Column | str) -> Column:
    e = _c(event)
    return e.withField("attempt", e.getField("attempt") + 1)


def job_name(granule_id: Column | str, attempt: Column | str) -> Column:
    """Job name: ID with dots turned to dashes, then ``_attempt``."""
    return F.concat(F.translate(_c(granule_id), ".", "-"), F.lit("_"), _c(attempt).cast("string"))


def work_request_env(
    granule_id: Column | str, attempt: Column | str, debug_bucket: Column | str | None, target_bucket: Column
) -> Column:
    """Container environment of a submitted job: ``OUTPUT_BUCKET`` first, then the event's variables."""
    return F.concat(F.array(_pair(ENV_OUTPUT_BUCKET, target_bucket)), event_to_env(granule_id, attempt, debug_bucket))


def target_bucket(output_bucket: str, debug_bucket: str | None = None) -> Column:
    """Deployment output: the debug bucket when one is configured, else the real output bucket."""
    return F.lit(debug_bucket if debug_bucket else output_bucket)
