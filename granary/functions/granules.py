"""Granule identifiers as column expressions.

An identifier is ``product.platform.tile.begin.vMAJOR.MINOR`` (exactly six dot-separated parts), with ``begin`` written
as year, day of year and time of day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Begin-time format inside a granule ID (year, day of year, 'T', hour, minute, second) and the calendar
# date format used in log paths.
GRANULE_TIME_FORMAT = "yyyyDDD'T'HHmmss"
DATE_FORMAT = "yyyy-MM-dd"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def granule_parts(granule_id: Column | str) -> Column:
    """Split an ID into ``struct(product, platform, tile, begin_datetime, version)``.

    The struct is null when the ID does not have exactly six parts or the begin time does not parse, so a bad ID never
    aborts a scan; use :func:`valid_granule_id` to route such rows elsewhere.
    """
    parts = F.split(_c(granule_id), r"\.")
    begin = F.try_to_timestamp(F.get(parts, 3), F.lit(GRANULE_TIME_FORMAT))
    struct = F.struct(
        F.get(parts, 0).alias("product"),
        F.get(parts, 1).alias("platform"),
        F.get(parts, 2).alias("tile"),
        begin.alias("begin_datetime"),
        F.concat_ws(".", F.get(parts, 4), F.get(parts, 5)).alias("version"),
    )
    return F.when((F.size(parts) == 6) & begin.isNotNull(), struct)


def valid_granule_id(granule_id: Column | str) -> Column:
    return granule_parts(granule_id).isNotNull()


def compose_granule_id(
    product: Column | str, platform: Column | str, tile: Column | str, begin: Column | str, version: Column | str
) -> Column:
    """Inverse of :func:`granule_parts`."""
    return F.concat_ws(
        ".", _c(product), _c(platform), _c(tile), F.date_format(_c(begin), GRANULE_TIME_FORMAT), _c(version)
    )


def acquisition_date(granule_id: Column | str) -> Column:
    """``YYYY-MM-DD`` of the granule's begin time (the log partition value)."""
    return F.date_format(granule_parts(granule_id).getField("begin_datetime"), DATE_FORMAT)


def platform(granule_id: Column | str) -> Column:
    return granule_parts(granule_id).getField("platform")
