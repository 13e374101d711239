"""Storage-inventory snapshots of the log prefix (one listing per ``dt``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.schemas import SNAPSHOT_SCHEMA
from granary.session import released_shuffles


def read_snapshot(spark: SparkSession, location: str) -> DataFrame:
    """A ``dt=``-partitioned Parquet listing; ``dt`` stays a string so ``max(dt)`` is the newest listing."""
    return (
        spark.read.schema(f"{SNAPSHOT_SCHEMA}, dt string")
        .option("basePath", location)
        .parquet(location)
    )


def read_snapshot_manifests(spark: SparkSession, location: str, dt: str | None = None) -> DataFrame:
    """Listing named by per-``dt`` manifest files (``dt=.../symlink.txt``, one data file per line).

    The newest ``dt`` is used unless one is given. The file names of that one listing come to the driver, where
    Spark's own file index keeps them anyway (it lists and splits a scan's files there); other days' files are never
    touched. The data files are read in parallel.
    """
    manifests = spark.read.text(f"{location.rstrip('/')}/dt=*/symlink.txt").select(
        F.regexp_extract(F.col("_metadata.file_path"), r"dt=([^/]+)/", 1).alias("dt"), F.col("value").alias("file")
    )
    chosen = dt or manifests.agg(F.max("dt")).first()[0]
    if chosen is None:
        return spark.createDataFrame([], f"{SNAPSHOT_SCHEMA}, dt string")
    files = [r["file"] for r in manifests.filter(F.col("dt") == chosen).select("file").collect() if r["file"]]
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(*files).withColumn("dt", F.lit(chosen))


def write_snapshot(df: DataFrame, location: str) -> None:
    """Add listings to a ``dt=``-partitioned Parquet listing. Files are in order of their keys, as listings are: neighbours share
    most of their text, and are stored in a fraction of the space."""
    with released_shuffles(df.sparkSession):
        df.sortWithinPartitions("dt", "key").write.mode("append").option("compression", "zstd").partitionBy("dt").parquet(location)
