"""Vectorised word and shingle hashing over Arrow text columns, shared by the free-style operators.

Words are found and hashed on the UTF-8 bytes of a slice of documents at once: a byte table maps each byte to its
normalised form (0 separates words), a polynomial hash modulo 2^64 over random byte values comes from one cumulative
sum, and every word hash passes a finaliser. Slices hold about ``SLICE_BYTES`` of text (always whole documents), so
memory stays bounded whatever the Arrow batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, size: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < size:
        steps = np.full(max(size, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        table = np.cumprod(steps, dtype=np.uint64)
        if size <= SLICE_BYTES + 1:  # a longer document's table is not kept
            _powers[name] = table
    return table


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche; one-to-one on 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_table(separators: str, lower: bool) -> np.ndarray:
    """uint8[256]: 0 for separators (given as Latin-1 characters below 0x80), else the byte, A-Z folded when asked."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A") : ord("Z") + 1] += 32
    for ch in separators:
        table[ord(ch)] = 0
    table[0] = 0
    return table


# Words of letters and digits: everything below 0x80 but 0-9, A-Z, a-z separates; A-Z folds to a-z.
ALNUM_TABLE = byte_table("".join(chr(i) for i in range(128) if not chr(i).isalnum()), lower=True)


def space_table(lower: bool) -> np.ndarray:
    """Words between the six ASCII white-space characters. Byte 0 is a word character there, so it gets a free value."""
    table = byte_table(" \t\n\v\f\r", lower)
    table[0] = 0xFF  # never occurs in UTF-8
    return table


@dataclass
class Words:
    """Words of ``n_docs`` documents: byte range, document index and 64-bit hash of each, in text order."""

    n_docs: int
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    buf: np.ndarray
    doc_offsets: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string column; null counts as empty."""
    col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, row after the last) of runs of whole documents of about ``limit`` bytes (one document at least)."""
    _, offsets = text_buffer(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words_of(col: pa.Array, table: np.ndarray) -> Words:
    buf, offsets = text_buffer(col)
    norm = table[buf]
    inside = norm != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(buf)]
    begins[edges] = inside[edges]  # a document start never continues the word before it
    starts = np.flatnonzero(begins)
    # a word ends before the next byte that is a separator, a word start or the end of the buffer
    stop = ~inside
    stop |= begins
    stops = np.append(np.flatnonzero(stop), len(buf))
    ends = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
    values = _BYTE_VALUES[norm]
    values *= _power_table("up", _BASE, len(buf) + 1)[: len(buf)]
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    hashes = mix64((sums[ends] - sums[starts]) * _power_table("down", _BASE_INV, len(buf) + 1)[starts])
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return Words(len(offsets) - 1, starts, ends, doc, hashes, buf, offsets)


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every run of ``size`` words; a document of fewer words, but some, has one shingle."""
    n = len(words.hashes)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    counts = words.counts()
    first = np.cumsum(counts) - counts
    acc = words.hashes.copy()
    mult = np.uint64(0xD6E8FEB86659FD93)
    length = np.minimum(counts, size)[words.doc]
    with np.errstate(over="ignore"):
        for k in range(1, size):
            tail = np.zeros(n, dtype=np.uint64)
            tail[: n - k] = words.hashes[k:]
            tail[k >= length] = 0  # short documents stop at their last word
            acc = acc * mult + tail
        acc = mix64(acc + length.astype(np.uint64))
    at = np.arange(n) - first[words.doc]
    keep = at <= (counts - length_of(counts, size))[words.doc]
    return words.doc[keep], acc[keep]


def length_of(counts: np.ndarray, size: int) -> np.ndarray:
    """Words in a shingle of each document: ``size``, or all its words when it has fewer."""
    return np.minimum(counts, size)
