"""Session settings and shared-storage helpers.

All times in the data model are UTC, so the session zone is pinned. ANSI mode stays on (Spark's default), and AQE is
enabled so that shuffle partitions are coalesced and skewed join partitions are split at run time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. They are applied to an existing session too, so library code behaves the same on a
# cluster session that was built elsewhere.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when that needs an extra shuffle after the join (the aggregates that follow
    # our joins are partial, so a hot granule is then spread over tasks and combined map-side)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a table of thousands of small folders is listed by some hundred tasks, not by one for each folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app_name: str = "granary") -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a cluster leave them unset so the
    deployment's values win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("GRANARY_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session that may have been built by someone else."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings of the session while a block runs; those of before hold again after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def released_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """While a block runs, the shuffle files of each write go when it is done, not when the driver's garbage is collected: jobs of
    several writes then need disk for the largest one, not for their sum."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only when the cluster names none (tests, laptops)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    local = os.environ.get("GRANARY_CHECKPOINT_DIR")
    if local is None:
        # executors of a cluster don't share a local folder: only a local master may fall back to one
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        local = f"/tmp/granary-checkpoints-{uuid.uuid4().hex[:8]}"
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir() or local


def path_of(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path string."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def file_paths(spark: SparkSession, statuses) -> list[str]:
    """Paths of file statuses as text, in one call to the JVM."""
    jvm = spark._jvm
    joined = jvm.scala.collection.mutable.ArraySeq.make(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)).mkString("\n")
    return joined.split("\n") if joined else []


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any Hadoop file system, sorted; empty if there is no such folder."""
    files, folder = path_of(spark, path)
    return sorted(p.rsplit("/", 1)[-1] for p in file_paths(spark, files.listStatus(folder))) if files.exists(folder) else []


def list_partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders (``name=value/...``, ``depth`` names) below a folder, by listing alone."""
    files, pattern = path_of(spark, f"{path.rstrip('/')}/{'/'.join(['*=*'] * depth)}")
    return sorted("/".join(p.rsplit("/", depth)[-depth:]) for p in file_paths(spark, files.globStatus(pattern)))


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    """Delete many folders, some at a time."""
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda path: delete_folder(spark, path), paths))


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = path_of(spark, path)
    files.delete(folder, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for staged tables and stream state."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
