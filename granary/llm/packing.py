"""Packing of token sequences into fixed windows (bounded-space online best fit).

Every partition streams its documents and keeps at most ``open_windows`` windows. A document is cut into full windows,
which leave at once, and a rest; the rest goes to the open window with the least room that still takes it. When none
does and the number of windows is at its limit, the fullest window is emitted (padded) to make place. What stays open
at the end of the partitions is written as leftovers and merged: the leftover pieces of ``merge_partitions``
neighbouring partitions form one group (bounded by partitions x windows) that is packed by best-fit decreasing.

Only piece descriptors leave the encoding pass; they are written once to the shared checkpoint folder, so a lost
executor repeats its own partitions and nothing is encoded twice for the merge.

Defined cases: a null or empty text has only its end id; repeated rows are packed each on their own; an empty table
gives no pieces; other columns are ignored; a very long text becomes several full windows and a rest.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.tokens import DEFAULT_TOKENIZER, encode_documents
from granary.session import scratch_path

MAX_LENGTH = 4096
END_ID = 2
OPEN_WINDOWS = 64
MERGE_PARTITIONS = 64

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int"
_COLUMNS = [c.split()[0] for c in PIECES.split(", ")]
_MERGED = 1 << 62  # sequence ids of merged leftovers have this bit

Piece = tuple  # (doc_id, start, length, crc, doc_tokens)


class WindowPacker:
    """Open windows in order of room; ``place`` yields (sequence, pieces) of every window that it closes."""

    def __init__(self, size: int, open_windows: int, first_id: int):
        self.size, self.limit, self.next_id = size, open_windows, first_id
        self.rooms: list[tuple[int, int]] = []  # (room, window id), ascending
        self.held: dict[int, list[Piece]] = {}

    def _new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, piece: Piece) -> Iterator[tuple[int, list[Piece]]]:
        length = piece[2]
        if length >= self.size:
            yield self._new(), [piece]
            return
        at = bisect.bisect_left(self.rooms, (length, -1))
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if len(self.rooms) >= self.limit:  # nothing takes it: the fullest window makes place
                _, fullest = self.rooms.pop(0)
                yield fullest, self.held.pop(fullest)
            room, window = self.size, self._new()
            self.held[window] = []
        self.held[window].append(piece)
        if room == length:
            yield window, self.held.pop(window)
        else:
            bisect.insort(self.rooms, (room - length, window))

    def rest(self) -> Iterator[tuple[int, list[Piece]]]:
        yield from sorted(self.held.items())
        self.rooms, self.held = [], {}


def cut(doc_id: int | None, ids: np.ndarray, size: int) -> Iterator[Piece]:
    """Full windows and the rest of one document."""
    for at in range(0, len(ids), size):
        part = ids[at : at + size]
        yield doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids)


def _rows(closed: list[tuple[int | None, list[Piece]]], part: int) -> list[tuple]:
    out = []
    for sequence, pieces in closed:
        offset = 0
        for piece in pieces:
            out.append((*piece, sequence, offset, part))
            offset += piece[2]
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 7 + [pa.int32()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_COLUMNS)


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
    merge_partitions: int = MERGE_PARTITIONS,
    tokenizer: str = DEFAULT_TOKENIZER,
) -> DataFrame:
    """One row per piece of the documents (``doc_id``, ``text``): where its ids lie in which sequence."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer = WindowPacker(max_length, open_windows, part << 32)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            closed: list = []
            for first, ids, bounds in encode_documents(batch.column(1), end_id, tokenizer):
                for k in range(len(bounds) - 1):
                    for piece in cut(doc_ids[first + k], ids[bounds[k] : bounds[k + 1]], max_length):
                        closed.extend(packer.place(piece))
            yield _batch(_rows(closed, part))
        yield _batch(_rows([(None, pieces) for _, pieces in packer.rest()], part))

    def merge(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        order = left.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        packer = WindowPacker(max_length, len(order) + 1, _MERGED + (int(key[0]) << 32))
        closed = []
        for row in order[_COLUMNS[:5]].itertuples(index=False):
            doc_id = None if pd.isna(row.doc_id) else int(row.doc_id)
            closed.extend(packer.place((doc_id, int(row.start), int(row.length), int(row.ids_crc32), int(row.doc_tokens))))
        closed.extend(packer.rest())
        return _batch(_rows(closed, -1)).to_pandas(types_mapper=lambda t: pd.Int64Dtype() if t == pa.int64() else None)

    spark = docs.sparkSession
    path = scratch_path(spark, "packing")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    source.mapInArrow(stream, PIECES).write.parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)
    done = pieces.filter(F.col("sequence_id").isNotNull())
    left = pieces.filter(F.col("sequence_id").isNull())
    merged = left.groupBy(F.floor(F.col("part") / merge_partitions).alias("merge_group")).applyInPandas(merge, PIECES)
    return done.unionByName(merged).drop("part")
