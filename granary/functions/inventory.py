"""Inventory listing lines to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One listing line is ``<granule_id> <start datetime or \N> <status> <t|f>``; the datetime is written as
# ``YYYY-MM-DD\ HH:MM:SS[.fff]+00``.
INVENTORY_LINE_PATTERN = r"^(\S+)\s(.*)\s(\S+)\s(t|f)$"
NULL_MARKER = "\\N"
COMPLETED = "completed"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def line_matches(line: Column | str) -> Column:
    return _c(line).rlike(INVENTORY_LINE_PATTERN)


def normalised_datetime_text(raw: Column) -> Column:
    """``\\N`` to null; ``\\ `` to ``T`` and ``+00`` to ``Z`` (first occurrence of each), giving ISO-8601 text."""
    text = F.regexp_replace(raw, r"\\ ", "T")
    text = F.regexp_replace(text, r"\+00", "Z")
    return F.when(raw != F.lit(NULL_MARKER), text)


def line_groups(line: Column | str) -> list[Column]:
    """The four pattern groups of a line plus a match flag: ``_ok, _gid, _dt, _status, _flag``.

    Select these in their own projection and type them with :func:`typed_line`; Catalyst then keeps each regex
    evaluation in one place instead of inlining it into every consumer (filters included).
    """
    v = _c(line)
    return [
        line_matches(v).alias("_ok"),
        F.regexp_extract(v, INVENTORY_LINE_PATTERN, 1).alias("_gid"),
        F.regexp_extract(v, INVENTORY_LINE_PATTERN, 2).alias("_dt"),
        F.regexp_extract(v, INVENTORY_LINE_PATTERN, 3).alias("_status"),
        F.regexp_extract(v, INVENTORY_LINE_PATTERN, 4).alias("_flag"),
    ]


def typed_line(line: Column | str, strict: bool = True) -> list[Column]:
    """Typed ``granule_id, start_datetime, status, published`` (+ ``parse_ok`` when not strict) from
    :func:`line_groups` columns.

    With ``strict`` a non-matching line or an unparseable datetime fails the job (as the single-file converter does);
    otherwise the columns of a bad line are null and ``parse_ok`` is false, so good and bad lines come out of one scan.
    """
    v = _c(line)
    ok = F.col("_ok")
    dt_text = normalised_datetime_text(F.col("_dt"))
    parsed_ts = F.try_to_timestamp(dt_text)
    dt_ok = dt_text.isNull() | parsed_ts.isNotNull()
    fields = {
        "granule_id": F.col("_gid"),
        "start_datetime": parsed_ts,
        "status": F.col("_status"),
        "published": F.col("_flag") == F.lit("t"),
    }
    if strict:
        bad_line = F.raise_error(F.concat(F.lit("Listing line has another form: "), v))
        bad_dt = F.raise_error(F.concat(F.lit("Listing line has a start time of another form: "), v))
        fields["granule_id"] = F.when(ok, fields["granule_id"]).otherwise(bad_line)
        fields["start_datetime"] = F.when(dt_ok, parsed_ts).otherwise(bad_dt)
        return [c.alias(name) for name, c in fields.items()]
    good = ok & dt_ok
    return [F.when(good, c).alias(name) for name, c in fields.items()] + [good.alias("parse_ok")]


def year_month(ts: Column | str) -> list[Column]:
    """Partition columns of the staging layout, as small ints."""
    t = _c(ts)
    return [F.year(t).cast("short").alias("year"), F.month(t).cast("short").alias("month")]
