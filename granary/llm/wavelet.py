"""Token-id shards as wavelet matrices: one compressed file per shard with access, counting and occurrence look-up.

File layout (all integers little-endian): 4 bytes ``GWM1``, uint32 length of a JSON header, the header, then the
sections it lists, each compressed with zstandard on its own: the bit-planes from the highest bit down, the number of
ones before each block of ``RANK_BLOCK`` bits for every plane, and the table of documents (id, null flag, ids).
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"GWM1"
RANK_BLOCK = 512
_LEVEL = 1  # the bits of frequent symbols compress a little; higher levels gain nothing
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class WaveletMatrix:
    """Succinct sequence of unsigned integers below ``2 ** bits``."""

    def __init__(self, n: int, bits: int, planes: list[np.ndarray], blocks: list[np.ndarray]):
        """``planes``: packed bits per level; ``blocks``: ones before each rank block, and in all as the last entry."""
        self.n, self.bits, self.planes, self.blocks = n, bits, planes, blocks
        self.zeros = [n - int(b[-1]) for b in blocks]

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        row = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, blocks = [], []
        for level in range(bits - 1, -1, -1):
            ones = (row >> row.dtype.type(level)) & row.dtype.type(1) != 0
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane)
            blocks.append(rank_blocks(plane))
            row = np.concatenate([row[np.flatnonzero(~ones)], row[np.flatnonzero(ones)]])
        return cls(len(ids), bits, planes, blocks)

    def decode(self) -> np.ndarray:
        """All values, by undoing the levels from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        row = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            above = np.empty(self.n, kind)
            above[np.flatnonzero(~ones)] = row[: self.zeros[level]]
            above[np.flatnonzero(ones)] = row[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            row = above
        return row.astype(np.uint32)

    def _bit(self, level: int, i: int) -> int:
        return (int(self.planes[level][i >> 3]) >> (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i`` of a level."""
        block = i // RANK_BLOCK
        first = block * RANK_BLOCK >> 3
        whole = int(_POPCOUNT[self.planes[level][first : i >> 3]].sum())
        part = int(self.planes[level][i >> 3]) & ((1 << (i & 7)) - 1) if i & 7 else 0
        return int(self.blocks[level][block]) + whole + part.bit_count()

    def _down(self, level: int, i: int, bit: int) -> int:
        ones = self._ones(level, i)
        return self.zeros[level] + ones if bit else i - ones

    def access(self, i: int) -> int:
        """The value at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.bits):
            bit = self._bit(level, i)
            value = value << 1 | bit
            i = self._down(level, i, bit)
        return value

    def _range(self, value: int, first: int, end: int) -> tuple[int, int]:
        for level in range(self.bits):
            bit = value >> (self.bits - 1 - level) & 1
            first, end = self._down(level, first, bit), self._down(level, end, bit)
        return first, end

    def count(self, value: int, first: int = 0, end: int | None = None) -> int:
        """Occurrences of ``value`` in positions [first, end)."""
        if value >> self.bits or value < 0:
            return 0
        low, high = self._range(value, first, self.n if end is None else end)
        return high - low

    rank = count

    def select(self, value: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``value``."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        i = self._range(value, 0, 0)[0] + k
        for level in range(self.bits - 1, -1, -1):
            i = self._up(level, i, value >> (self.bits - 1 - level) & 1)
        return i

    def _up(self, level: int, i: int, bit: int) -> int:
        """The position of a level whose image in the next one is ``i``: a search over block counts, then bits."""
        want = i - self.zeros[level] if bit else i
        counts = self.blocks[level].astype(np.int64)
        if not bit:
            counts = np.minimum(np.arange(len(counts)) * RANK_BLOCK, self.n) - counts
        block = int(np.searchsorted(counts, want, side="right")) - 1
        first = block * RANK_BLOCK
        bits = np.unpackbits(self.planes[level][first >> 3 : (first + RANK_BLOCK) >> 3], bitorder="little")
        return first + int(np.flatnonzero(bits[: self.n - first] == bit)[want - int(counts[block])])

    def occurrences(self, value: int) -> list[int]:
        """All positions of ``value``, ascending."""
        return [self.select(value, k) for k in range(self.count(value))]


def rank_blocks(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of ``RANK_BLOCK`` bits, and the number of all ones at the end."""
    step = RANK_BLOCK >> 3
    ones = _POPCOUNT[plane]
    sums = np.add.reduceat(ones, np.arange(0, len(ones), step), dtype=np.uint32) if len(ones) else np.zeros(0, np.uint32)
    return np.concatenate([[0], np.cumsum(sums)]).astype("<u4")


def write_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, extra: dict) -> bytes:
    """The file of one shard: documents in order, their ids as one wavelet matrix; ``extra`` goes to the header."""
    matrix = WaveletMatrix.build(ids)
    press = zstandard.ZstdCompressor(level=_LEVEL)
    sections = [press.compress(p.tobytes()) for p in matrix.planes]
    sections += [press.compress(b.tobytes()) for b in matrix.blocks]
    sections.append(press.compress(np.array([d or 0 for d in doc_ids], "<i8").tobytes()))
    sections.append(press.compress(np.array([d is None for d in doc_ids], "<u1").tobytes()))
    sections.append(press.compress(np.asarray(lengths, "<u4").tobytes()))
    head = {"n": matrix.n, "bits": matrix.bits, "docs": len(doc_ids), "sections": [len(s) for s in sections]}
    header = json.dumps(head | {"extra": extra}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


class Shard:
    """A shard file read back; the sections are decompressed when they are first asked for."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("not a token shard")
        (size,) = struct.unpack("<I", content[4:8])
        self.header = json.loads(content[8 : 8 + size])
        self.extra = self.header["extra"]
        ends = np.cumsum([8 + size, *self.header["sections"]])
        self._raw = [content[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        ids, nulls, lengths = (self._section(k, t) for k, t in ((-3, "<i8"), (-2, "<u1"), (-1, "<u4")))
        self.doc_ids = [None if null else int(i) for i, null in zip(ids, nulls, strict=True)]
        self.lengths = lengths.astype(np.int64)

    def _section(self, k: int, kind: str) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self._raw[k]), dtype=kind)

    def matrix(self) -> WaveletMatrix:
        bits = self.header["bits"]
        planes = [self._section(k, "<u1") for k in range(bits)]
        return WaveletMatrix(self.header["n"], bits, planes, [self._section(bits + k, "<u4") for k in range(bits)])
