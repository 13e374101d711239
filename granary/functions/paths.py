"""Log object keys: build, parse (strict and lenient) and small path helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.granules import acquisition_date, platform

# The key layout of one attempt log, the strict parse pattern applied after the logs prefix, the
# attempt file-name pattern, and the five independent extracts used by the reporting view.
LOG_PATH_PATTERN = (
    r"^outcome=(\w+)/platform=(\w+)/acquisition_date=([\d-]+)/granule_id=([\w\.]+)/attempt=([0-9]+)\.json$"
)
ATTEMPT_FILE_PATTERN = r"^attempt=[0-9]+\.json$"
VIEW_EXTRACTS = {
    "outcome": r"outcome=(\w+)",
    "platform": r"platform=(\w+)",
    "acquisition_date": r"acquisition_date=([\d-]+)",
    "granule_id": r"granule_id=([\w\.]+)",
    "attempt": r"attempt=([0-9]+)",
}
OBJECT_URI_PATTERN = r"^s3://([^/]+)/(.*)$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def log_key(prefix: str, outcome: Column | str, granule_id: Column | str, attempt: Column | str) -> Column:
    """``prefix/outcome=../platform=../acquisition_date=../granule_id=../attempt=N.json``."""
    gid = _c(granule_id)
    parts = [
        F.concat(F.lit("outcome="), _c(outcome)),
        F.concat(F.lit("platform="), platform(gid)),
        F.concat(F.lit("acquisition_date="), acquisition_date(gid)),
        F.concat(F.lit("granule_id="), gid),
        F.concat(F.lit("attempt="), _c(attempt).cast("string"), F.lit(".json")),
    ]
    clean = prefix.strip("/")
    return F.concat_ws("/", *([F.lit(clean)] if clean else []), *parts)


def _strip_prefix(key: Column, prefix: str) -> Column:
    clean = prefix.strip("/")
    if not clean:
        return F.regexp_replace(key, r"^/+", "")
    return F.regexp_replace(F.regexp_replace(key, "^" + _quote(clean), ""), r"^/+", "")


def _quote(text: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in text)


def parse_log_key(key: Column | str, prefix: str = "logs", strict: bool = True) -> Column:
    """Parse a key into ``struct(outcome, platform, acquisition_date, granule_id, attempt)``.

    ``strict`` fails the job on a key that does not match (as the single-object parser does); otherwise the struct is
    null for such keys, for a quarantine split.
    """
    path = _strip_prefix(_c(key), prefix)
    matched = path.rlike(LOG_PATH_PATTERN)
    parsed = F.struct(
        F.regexp_extract(path, LOG_PATH_PATTERN, 1).alias("outcome"),
        F.regexp_extract(path, LOG_PATH_PATTERN, 2).alias("platform"),
        F.regexp_extract(path, LOG_PATH_PATTERN, 3).alias("acquisition_date"),
        F.regexp_extract(path, LOG_PATH_PATTERN, 4).alias("granule_id"),
        F.regexp_extract(path, LOG_PATH_PATTERN, 5).cast("int").alias("attempt"),
    )
    if strict:
        return F.when(matched, parsed).otherwise(
            F.raise_error(F.concat(F.lit("Cannot parse log key into an event: "), _c(key)))
        )
    return F.when(matched, parsed)


def view_columns(key: Column | str) -> list[Column]:
    """The reporting view's five lenient extracts: null on a miss, never an error."""
    k = _c(key)

    def grab(name: str) -> Column:
        return F.nullif(F.regexp_extract(k, VIEW_EXTRACTS[name], 1), F.lit(""))

    return [
        grab("outcome").alias("outcome"),
        grab("platform").alias("platform"),
        F.try_to_timestamp(grab("acquisition_date"), F.lit("yyyy-MM-dd")).alias("acquisition_date"),
        grab("granule_id").alias("granule_id"),
        grab("attempt").cast("int").alias("attempt"),
    ]


def basename(path: Column | str) -> Column:
    return F.substring_index(_c(path), "/", -1)


def is_attempt_file(path: Column | str) -> Column:
    return basename(path).rlike(ATTEMPT_FILE_PATTERN)


def inventory_identifier(path: Column | str) -> Column:
    """Last path part of an inventory location."""
    return basename(path)


def uri_bucket(uri: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(uri), OBJECT_URI_PATTERN, 1), F.lit(""))


def uri_key(uri: Column | str) -> Column:
    return F.when(_c(uri).rlike(OBJECT_URI_PATTERN), F.regexp_extract(_c(uri), OBJECT_URI_PATTERN, 2))
