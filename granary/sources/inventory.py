"""Inventory listings in (text) and inventory tables out (Parquet).

A row's position in its inventory (``inventory_seq``) is not stored with it. Rows are written once, in order: the files of
an inventory follow each other by number, and so do the rows of a file. A stored catalogue has the files of all
inventories with the number of rows of each, from the Parquet footers, and of the rows before it; a position is that
number plus the row's index in its file. Counts come from the catalogue alone, and a slice of an inventory names its files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions import paths as pth
from granary.sources import commits

# Fixed value: what the path of a parquet inventory under the inventories prefix holds.
INVENTORY_PATTERN = r"cumulus-rds-granules.*\.parquet$"
_FOLDER = r"^(.*/inventory=[^/]+)/[^/]+$"


def read_inventory_text(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Listing text files, one line per row, no header: ``inventory`` (file name) and ``value``.

    Input splits give bounded memory per task whatever the file sizes are; blank lines are dropped by the parser.
    """
    files = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("recursiveFileLookup", "true").text(files)
    return df.select(inventory_name(F.col("_metadata.file_path")).alias("inventory"), "value")


def inventory_path(file: Column) -> Column:
    """Path of the inventory that a file belongs to: its ``inventory=`` folder, or the file itself."""
    return F.coalesce(F.nullif(F.regexp_extract(file, _FOLDER, 1), F.lit("")), file)


def inventory_name(file: Column) -> Column:
    """Name of a file's inventory: the value of its ``inventory=`` folder, or the file's name."""
    return F.regexp_replace(pth.basename(inventory_path(file)), "^inventory=", "")


def read_inventory(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A converted inventory table; ``columns`` limits the scan (the feed reads only what it needs).

    ``inventory_seq`` comes from the catalogue, unless the rows hold it.
    """
    df = spark.read.parquet(path)
    if "inventory_seq" not in df.columns and (columns is None or "inventory_seq" in columns):
        files = read_catalog(spark, path).select("file", "first_seq")  # a row per file
        df = df.select("*", "_metadata.file_path", "_metadata.row_index").join(files, F.col("file_path") == F.col("file"))
        df = df.withColumn("inventory_seq", F.col("first_seq") + F.col("row_index")).drop("file_path", "row_index", "file", "first_seq")
    return df.select(*columns) if columns else df


def discover_inventories(spark: SparkSession, prefix: str, pattern: str = INVENTORY_PATTERN) -> DataFrame:
    """Rows of all Parquet inventories under ``prefix`` (recursive) whose whole path matches the pattern.

    ``inventory`` is the inventory's path, so equal names in different folders stay apart. The pattern is a filter on
    file paths; nothing is listed to the driver beside Spark's own file index.
    """
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(prefix)
    file = F.col("_metadata.file_path")
    found = df.filter(inventory_path(file).rlike(pattern) | file.rlike(pattern))
    return found.withColumn("inventory", inventory_path(file))


def count_rows(inventories: DataFrame) -> DataFrame:
    """``(inventory, 0, total)`` progress records, one per discovered inventory (a scan of no columns)."""
    return inventories.groupBy("inventory").agg(
        F.lit(0).cast("bigint").alias("submitted_count"), F.count(F.lit(1)).alias("total_count")
    )


CATALOG = "_catalog"
CATALOG_SCHEMA = "inventory string, file string, first_seq bigint, rows bigint"
FOOTERS = 64  # read by one task
_FILE_NUMBER = r"part-(\d+)"


def _footer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        rows = []
        for file in batch.column(0).to_pylist():
            files, path = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", file))
            with files.open_input_file(path) as source:
                rows.append(pq.ParquetFile(source).metadata.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.int64())], names=["file", "rows"])


def _readable(file: str) -> bool:
    """Whether tasks can open a file by its URI without Spark."""
    from pyarrow import fs

    try:
        fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", file))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def footer_rows(spark: SparkSession, files: list[str]) -> DataFrame:
    """``(file, rows)`` of Parquet files, from their footers: no column is read. In a store that only Spark can open, a scan
    without columns counts them."""
    frame = spark.createDataFrame([(f,) for f in files], "file string")
    if files and not _readable(files[0]):
        counted = spark.read.parquet(*map(_path, files)).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        return frame.join(counted, "file", "left").select("file", F.coalesce("rows", F.lit(0)).alias("rows"))
    tasks = max(1, -(-len(files) // FOOTERS))
    return frame.repartition(tasks).mapInArrow(_footer_rows, "file string, rows bigint")


def catalog(spark: SparkSession, prefix: str, pattern: str = INVENTORY_PATTERN) -> DataFrame:
    """The files of all Parquet inventories under ``prefix`` (recursive) whose path matches the pattern, with the number of
    rows in each and before it. ``inventory`` is the inventory's path, so equal names in different folders stay apart.

    The file names are those of Spark's file index, which lists them on the driver for any scan.
    """
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(prefix).inputFiles()
    wanted = re.compile(pattern)

    def own(file: str) -> str:
        folder = re.match(_FOLDER, file)
        return folder[1] if folder else file

    files = [f for f in (re.sub("^file:/+", "file:/", f) for f in found) if wanted.search(own(f)) or wanted.search(f)]
    counted = footer_rows(spark, files).select(inventory_path(F.col("file")).alias("inventory"), "file", "rows")
    number = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(pth.basename("file"), _FILE_NUMBER, 1), F.lit("")), F.lit("9" * 18)), F.lit(0))
    before = Window.partitionBy("inventory").orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("inventory", "file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first_seq"), "rows")


def store_catalog(spark: SparkSession, prefix: str, pattern: str = INVENTORY_PATTERN) -> int:
    """Build the catalogue anew and commit it under ``prefix``; returns its version. Readers see the whole of it or the last one."""
    base = f"{prefix.rstrip('/')}/{CATALOG}"
    folder = f"files-{uuid.uuid4().hex}"
    catalog(spark, prefix, pattern).coalesce(1).write.parquet(f"{base}/{folder}")
    return commits.change(spark, base, lambda version, before: {"folder": folder})


def read_catalog(spark: SparkSession, prefix: str) -> DataFrame:
    """The stored catalogue, made now if there is none."""
    base = f"{prefix.rstrip('/')}/{CATALOG}"
    if commits.latest(spark, base) is None:
        store_catalog(spark, prefix)
    return spark.read.schema(CATALOG_SCHEMA).parquet(f"{base}/{commits.latest(spark, base)[1]['folder']}")


def catalog_counts(files: DataFrame) -> DataFrame:
    """``(inventory, 0, total)`` progress records from a catalogue."""
    return files.groupBy("inventory").agg(F.lit(0).cast("bigint").alias("submitted_count"), F.sum("rows").alias("total_count"))


def read_slice(spark: SparkSession, files: DataFrame, inventory: str, start: int, end: int, columns: list[str]) -> DataFrame:
    """Rows ``[start, end)`` of an inventory with ``inventory`` and ``inventory_seq``: only the files that hold them are opened.

    Their names come to the driver; a slice has no more files than rows.
    """
    inside = (F.col("inventory") == inventory) & (F.col("first_seq") < end) & (F.col("first_seq") + F.col("rows") > start)
    chosen = {r["file"]: r["first_seq"] for r in files.filter(inside).select("file", "first_seq").collect()}
    if not chosen:
        kinds = spark.read.option("recursiveFileLookup", "true").parquet(_path(inventory)).select(*columns).schema
        return spark.createDataFrame([], kinds).select(*columns, F.lit(inventory).alias("inventory"), F.lit(0).cast("bigint").alias("inventory_seq"))
    first = F.create_map(*[F.lit(x) for pair in chosen.items() for x in pair])
    rows = spark.read.parquet(*[_path(f) for f in chosen]).select(*columns, "_metadata.file_path", "_metadata.row_index")
    rows = rows.withColumn("inventory_seq", first[F.col("file_path")] + F.col("row_index"))
    rows = rows.filter((F.col("inventory_seq") >= start) & (F.col("inventory_seq") < end))
    return rows.select(*columns, F.lit(inventory).alias("inventory"), "inventory_seq")


def _path(uri: str) -> str:
    """A path that readers take, from a file's URI."""
    return unquote(uri)


def write_ordered(df: DataFrame, path: str, order: list[Column], as_date: bool = True) -> None:
    """Rows of all inventories (``inventory`` column) in ``order``, written once: one snappy Parquet table per inventory whose
    files follow each other, and the catalogue from which positions come.

    Range partitions cut a hot day or a hot inventory into many tasks; each writes what it has sorted.
    """
    keys = [F.col("inventory").asc(), *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out = ranged.withColumn("start_datetime", F.col("start_datetime").cast("date")) if as_date else ranged
    out.write.mode("overwrite").option("compression", "snappy").partitionBy("inventory").parquet(path)
    store_catalog(df.sparkSession, path, pattern="")


def write_inventory(df: DataFrame, path: str, as_date: bool = True, mode: str = "overwrite") -> None:
    """One snappy Parquet table per listing (``inventory=`` folders), rows in ``inventory_seq`` order.

    ``as_date`` stores ``start_datetime`` as DATE, the declared column type; order lives in ``inventory_seq``, so the
    number of files does not matter.
    """
    out = df.withColumn("start_datetime", F.col("start_datetime").cast("date")) if as_date else df
    # numbered rows come in order from a range partitioning already: sorting what each task holds is enough
    out = out.sortWithinPartitions("inventory", "inventory_seq")
    out.write.mode(mode).option("compression", "snappy").partitionBy("inventory").parquet(path)


def write_monthly(df: DataFrame, path: str) -> None:
    """Year/month partitioned staging layout, appended (new file names on every write); few files per month."""
    df.hint("rebalance", "year", "month").write.mode("append").partitionBy("year", "month").parquet(path)
