"""Inventory conversion: listing lines to one newest-first table per listing, with a materialised row position.

Row order is data here (the feed walks row numbers), and Spark has no row order, so conversion stores it as
``inventory_seq``. The position is computed without a single-partition window:

1. range-partition and sort on ``(inventory, start_datetime desc nulls last, granule_id)``; the key is total, so a hot
   day or a hot listing spreads over many range partitions;
2. tag each row with its partition id and ``monotonically_increasing_id`` and write the tagged rows as a Parquet table
   in the shared checkpoint folder, so the tags are fixed data even if an executor is lost later;
3. count rows per ``(partition, inventory)`` from two columns (a table of at most partitions + listings rows), turn the counts into
   offsets with a window over that small table, and join them back. AQE broadcasts the offsets when their measured
   size is small and falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import inventory as inv_fn
from granary.session import scratch_path

def inventory_order() -> list[Column]:
    return [F.col("start_datetime").desc_nulls_last(), F.col("granule_id").asc()]


def parse_inventory(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Parse listing lines (``value`` column, other columns kept) into inventory columns; blank lines are skipped.

    ``strict`` fails the job on the first bad line. Otherwise a ``parse_ok`` flag marks bad lines (their parsed
    columns are null) and ``value`` is kept, so good and bad rows come out of one scan and can be written side by side.
    """
    keep = [c for c in lines.columns if c != "value"]
    nonblank = lines.filter(F.length("value") > 0)
    groups = nonblank.select(*keep, "value", *inv_fn.line_groups("value"))
    typed = groups.select(*keep, *inv_fn.typed_line("value", strict=strict), "value")
    return typed.drop("value") if strict else typed


def number_rows(
    df: DataFrame,
    order: list[Column],
    group: list[str] | None = None,
    seq_col: str = "inventory_seq",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 0-based position of each row within its ``group`` under ``order`` (``order`` must be total)."""
    group = group or []
    spark = df.sparkSession
    sort_cols = [F.col(g).asc() for g in group] + order
    # without an explicit count AQE may coalesce adjacent range partitions, which keeps the range order
    ranged = df.repartitionByRange(num_partitions, *sort_cols) if num_partitions else df.repartitionByRange(*sort_cols)
    ranged = ranged.sortWithinPartitions(*sort_cols)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered-rows")
    tagged.write.parquet(path)
    tagged = spark.read.schema(tagged.schema).parquet(path)

    stats = tagged.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        "_pid", *group, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    numbered = tagged.join(offsets, ["_pid", *group], "inner")
    seq = (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("bigint")
    return numbered.withColumn(seq_col, seq).drop("_pid", "_mid", "_first", "_offset")


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad lines of a parse that is not strict: ``(rows, lines)``, together all that was parsed."""
    bad = parsed.filter(~F.col("parse_ok"))
    keep = [c for c in ("inventory",) if c in parsed.columns]
    return parsed.filter("parse_ok").drop("parse_ok", "value"), bad.select(*keep, "value")


def completed_rows(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Completed rows of listing lines; without ``strict`` bad lines are left out (write those of ``quarantine`` beside them)."""
    parsed = parse_inventory(lines, strict=strict)
    if not strict:
        parsed, _ = quarantine(parsed)
    return completed(parsed)


def completed(rows: DataFrame) -> DataFrame:
    """Parsed rows of completed granules (F1)."""
    return rows.filter(F.col("status") == inv_fn.COMPLETED)


def convert_inventory(lines: DataFrame, strict: bool = True, num_partitions: int | None = None) -> DataFrame:
    """Listing lines ``(inventory, value)`` to completed rows, newest first, numbered per inventory.

    Without ``strict`` only the good rows are converted; write the bad lines of ``quarantine`` beside them.

    Output: ``inventory, granule_id, start_datetime, status, published, inventory_seq``. Inventory tables are written
    without the position (``sources.inventory.write_ordered``), so they don't need the staged copy; this is the form for
    further work in the same job. The sort uses the full timestamp, so the order is a refinement of day order.
    """
    completed = completed_rows(lines, strict)
    group = ["inventory"] if "inventory" in completed.columns else []
    return number_rows(completed, inventory_order(), group=group, num_partitions=num_partitions)


def monthly_layout(inventory: DataFrame) -> DataFrame:
    """Staging layout columns (``year``, ``month`` as small ints) for a year/month partitioned write."""
    return inventory.select("*", *inv_fn.year_month("start_datetime"))


def inventory_counts(inventory: DataFrame) -> DataFrame:
    """Rows per inventory, as fresh progress records ``(inventory, 0, total)``."""
    return inventory.groupBy("inventory").agg(
        F.lit(0).cast("bigint").alias("submitted_count"), F.count(F.lit(1)).alias("total_count")
    )
