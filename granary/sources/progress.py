"""Progress table: NDJSON records in a folder per write; the newest commit names the current one.

Create only if absent; reading a missing table is an error; a write must name the version it read and is refused if
another writer has moved on since. Both conditions are part of the commit itself (``sources.commits``): of any number of
writers that read the same version, exactly one gets the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.schemas import PROGRESS_SCHEMA
from granary.session import delete_folder
from granary.sources import commits


class ProgressNotFoundError(FileNotFoundError):
    """No progress table exists yet; create it first."""


class ProgressConflictError(RuntimeError):
    """The progress table moved on since it was read."""


def latest_version(spark: SparkSession, path: str) -> int | None:
    found = commits.versions(spark, path)
    return found[-1] if found else None


def read_progress(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """``(records, version)`` of the current progress; raises ``ProgressNotFoundError`` if there is none."""
    found = commits.latest(spark, path)
    if found is None:
        raise ProgressNotFoundError(f"No progress table at {path}")
    version, document = found
    return spark.read.schema(PROGRESS_SCHEMA).json(f"{path.rstrip('/')}/{document['folder']}"), version


def create_progress(spark: SparkSession, path: str, records: DataFrame) -> int:
    """Write version 0; fails if any version already exists."""
    return _commit(spark, path, records, -1)


def update_progress(spark: SparkSession, path: str, records: DataFrame, read_version: int) -> int:
    """Write ``read_version + 1`` if ``read_version`` is still the latest; returns the new version."""
    return _commit(spark, path, records, read_version)


def change_progress(spark: SparkSession, path: str, step: Callable[[DataFrame], DataFrame], tries: int = commits.TRIES) -> int:
    """Apply ``step`` to the current records and store the result, anew on what others have stored if they were first."""
    for _ in range(tries):
        records, version = read_progress(spark, path)
        try:
            return update_progress(spark, path, step(records), version)
        except ProgressConflictError:
            continue
    raise ProgressConflictError(f"Progress at {path} changed {tries} times")


def _commit(spark: SparkSession, path: str, records: DataFrame, read_version: int) -> int:
    base, folder = path.rstrip("/"), f"records-{uuid.uuid4().hex}"
    current = latest_version(spark, path)
    won = False
    if (-1 if current is None else current) == read_version:
        out = records.select(
            F.col("inventory").cast("string"),
            F.col("submitted_count").cast("bigint"),
            F.col("total_count").cast("bigint"),
        )
        out.coalesce(1).write.json(f"{base}/{folder}")
        won = commits.commit(spark, path, read_version + 1, {"folder": folder})
        if not won:
            delete_folder(spark, f"{base}/{folder}")
    if not won:
        raise ProgressConflictError(f"Progress at {path} is not at version {read_version} (-1: none) any more")
    return read_version + 1
