"""Token-id output: documents in ascending id order as wavelet-matrix shard files, and their reader.

Documents are range-partitioned on their id (a sampled sort, so no task sees more than its share), encoded, and
written by each task as shards of about ``shard_tokens`` ids into a folder that all executors share. A shard goes to a
temporary name first and is renamed, so a task that runs again replaces its own files and a reader never sees half a
file. The manifest (one row per shard) is written when all shards are.

Defined cases: a null or empty text has only the end id; a null id sorts first; repeated rows are documents of their
own; an empty table has an empty manifest; a document longer than a shard makes a longer shard; other columns are
ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from granary.llm.tokens import DEFAULT_TOKENIZER, encode_documents
from granary.llm.wavelet import Shard, write_shard

END_ID = 1
SLICE_BYTES = 4 << 20  # text that the encoder takes at a time
SHARD_TOKENS = 1 << 20

MANIFEST = "part int, shard int, file string, n_docs long, n_tokens long"
TOKENS = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"


def shared_filesystem(uri: str):
    """(file system, path) of a folder that every executor reaches by the same URI."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def write_tokens(
    docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, tokenizer: str = DEFAULT_TOKENIZER
) -> DataFrame:
    """Write the shards of the documents (``doc_id``, ``text``) under ``path``/shards; returns the manifest."""

    def emit(files, folder: str, part: int, shard: int, before: int, held: list) -> tuple:
        ids = np.concatenate([x for _, x in held])
        content = write_shard([d for d, _ in held], np.array([len(x) for _, x in held]), ids, {"part": part, "before": before})
        name = f"{part:06d}-{shard:06d}.gwm"
        files.create_dir(folder, recursive=True)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(content)
        files.move(draft, f"{folder}/{name}")
        return part, shard, name, len(held), len(ids)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = shared_filesystem(path)
        folder = folder.rstrip("/") + "/shards"
        part = TaskContext.get().partitionId()
        held, size, before, rows = [], 0, 0, []
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, ids, bounds in encode_documents(batch.column(1), end_id, tokenizer, SLICE_BYTES):
                for k in range(len(bounds) - 1):
                    held.append((doc_ids[first + k], ids[bounds[k] : bounds[k + 1]]))
                    size += len(held[-1][1])
                    if size >= shard_tokens:
                        rows.append(emit(files, folder, part, len(rows), before, held))
                        held, size, before = [], 0, before + size
        if held:
            rows.append(emit(files, folder, part, len(rows), before, held))
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        names = ["part", "shard", "file", "n_docs", "n_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the shards under ``path``: position and number of their ids, and the CRC-32 of the ids.

    Positions within a part are in the files; what lies before a part is a running sum over one row per part.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                shard = Shard(content.as_py())
                ids = shard.matrix().decode().astype("<u4", copy=False)
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                columns = [
                    pa.array(np.full(len(ends), shard.extra["part"]), pa.int32()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(starts + shard.extra["before"], pa.int64()),
                    pa.array(shard.lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "start", "n_tokens", "ids_crc32"])

    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # one row per written part, and so the broadcast: its size goes with the number of tasks that wrote
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    if manifest.isEmpty():
        return spark.createDataFrame([], TOKENS).drop("part")
    # drafts of lost tasks have hidden names, which file sources leave out
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.gwm").load(f"{path}/shards").select("content")
    rows = content.mapInArrow(read, TOKENS)
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def shard_paths(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with full paths, for readers that open single shards (``wavelet.Shard``)."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    return manifest.withColumn("path", F.concat(F.lit(os.path.join(path, "shards") + "/"), "file"))
