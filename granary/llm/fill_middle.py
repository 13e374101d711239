"""Fill-in-middle transformation: documents cut at two unit boundaries and put together in another order.

The characters of a slice of documents become classes (inside or at the start of a word, of a run of white space, of a
line break), held in one wavelet matrix (``class_matrix``). Counts of classes combine into counts of boundaries: a
document's number of units, and by bisection on the ranks the character at which its first k units end. So all cuts of
a slice are found at once, whatever the lengths of its documents.

Units: ``word`` is white space with the word after it (white space that ends a text is a unit of its own); ``line`` is a
line with its line feed. Which units are cut and in which form a document is written hang on the SHA-256 of the seed and
its id alone, so any task that runs again writes the same.

Forms: ``psm`` prefix, suffix, middle; ``spm`` suffix, prefix, middle; ``plain`` the text as it is. ``restored`` undoes them.

Defined cases: a null or empty text is plain with 0 units; a text that holds one of the markers is plain; a null id hashes
as an empty one; rows with equal ids are cut alike; repeated rows are documents of their own; an empty table has an empty
result; other columns are ignored; a very long text is one slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.class_matrix import ClassMatrix
from granary.llm.textnp import slices, text_buffer

SEED = "42"
MARKERS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
FIM_PERCENT = 50
SPM_PERCENT = 80
SLICE_BYTES = 1 << 20

OUTPUT = "doc_id long, n_units long, form string, prefix_chars long, middle_chars long, output string"

# Classes: the kind of character, and (odd) whether it starts a word or a run of white space.
WORD, WORD_START, SPACE, SPACE_START, BREAK, BREAK_START = range(6)
_BITS = 3
_KIND = np.zeros(256, np.uint8)
_KIND[[ord(c) for c in " \t\v\f\r"]] = SPACE
_KIND[ord("\n")] = BREAK
_RUNS = (SPACE_START, BREAK_START)
_BREAKS = (BREAK, BREAK_START)


class Slice:
    """Characters of some documents, their classes as a wavelet matrix, and the documents' bounds in it."""

    def __init__(self, col: pa.Array):
        self.buf, self.byte_bounds = text_buffer(col)
        lead = (self.buf & 0xC0) != 0x80
        self.at = np.append(np.flatnonzero(lead), len(self.buf))  # first byte of each character
        self.bounds = np.searchsorted(self.at, self.byte_bounds)
        kinds = _KIND[self.buf[self.at[:-1]]]
        blank = kinds != WORD
        starts = np.ones(len(kinds), bool)
        starts[1:] = blank[1:] != blank[:-1]
        first, end = self.bounds[:-1], self.bounds[1:]
        starts[first[first < len(kinds)]] = True
        self.matrix = ClassMatrix(kinds + starts, _BITS)
        some = first < end
        self.opens_blank = some & np.append(blank, False)[first]
        self.ends_blank = some & np.append(blank, False)[np.maximum(end - 1, 0)]
        self.ends_break = some & np.append(kinds == BREAK, False)[np.maximum(end - 1, 0)]

    def _between(self, kinds: tuple[int, ...]) -> np.ndarray:
        return self.matrix.ranks(kinds, self.bounds[1:]) - self.matrix.ranks(kinds, self.bounds[:-1])

    def units(self, unit: str) -> np.ndarray:
        """Units of each document."""
        if unit == "word":
            return self._between((WORD_START,)) + self.ends_blank
        return self._between(_BREAKS) + ((self.bounds[1:] > self.bounds[:-1]) & ~self.ends_break)

    def ends(self, unit: str, k: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Character at which the first ``k`` of the ``n`` units of each document end."""
        first, end = self.bounds[:-1], self.bounds[1:]
        kinds = _RUNS if unit == "word" else _BREAKS
        # a word ends where the next run of white space starts: one run more in a document that opens with one
        want = self.matrix.ranks(kinds, first) + k + (self.opens_blank if unit == "word" else 0)
        at = self.matrix.bisect(kinds, want, first, end)
        at = at - 1 if unit == "word" else at  # the boundary lies before the run's first character, but after a line feed
        return np.where(k <= 0, first, np.where(k >= n, end, at))


def hashes(seed: str, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def _checked(markers: tuple[str, str, str]) -> tuple[bytes, ...]:
    """The markers as bytes. None may hold another, and the first character of each must not occur further on in any: then
    no marker can begin in the text before one and end in it."""
    nested = any(m != other and m in other for m in markers for other in markers)
    if nested or len(set(markers)) != 3 or any(m[0] in other[1:] for m in markers for other in markers) or not all(map(str.isascii, markers)):
        raise ValueError(f"markers that can't be told apart: {markers}")
    return tuple(m.encode() for m in markers)


def transform(
    docs: DataFrame,
    unit: str = "word",
    seed: str = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """One row per document (``doc_id``, ``text``): its units, form, the lengths of prefix and middle, and the output."""
    if unit not in ("word", "line"):
        raise ValueError(f"no such unit: {unit}")
    before_prefix, before_suffix, before_middle = marks = _checked(markers)

    def cut(doc_ids: list, col: pa.Array) -> pa.RecordBatch:
        piece = Slice(col)
        n = piece.units(unit)
        h = np.array([hashes(seed, d) for d in doc_ids], np.int64).reshape(-1, 4)
        one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
        low = piece.ends(unit, np.minimum(one, two), n)
        high = piece.ends(unit, np.maximum(one, two), n)
        content = piece.buf.tobytes()
        a, b, c, d = (x.tolist() for x in (piece.byte_bounds[:-1], piece.at[low], piece.at[high], piece.byte_bounds[1:]))
        fim, spm = (h[:, 2] % 100 < fim_percent).tolist(), (h[:, 3] % 100 < spm_percent).tolist()
        forms, outputs = [], []
        for k in range(len(doc_ids)):
            text = content[a[k] : d[k]]
            if not text or not fim[k] or any(m in text for m in marks):
                forms.append("plain")
                outputs.append(text)
                continue
            prefix, middle, suffix = content[a[k] : b[k]], content[b[k] : c[k]], content[c[k] : d[k]]
            forms.append("spm" if spm[k] else "psm")
            head = (before_suffix, suffix, before_prefix, prefix) if spm[k] else (before_prefix, prefix, before_suffix, suffix)
            outputs.append(b"".join([*head, before_middle, middle]))
        plain = np.array([f == "plain" for f in forms], bool)
        columns = [
            pa.array(doc_ids, pa.int64()),
            pa.array(n.astype(np.int64)),
            pa.array(forms, pa.string()),
            pa.array(low - piece.bounds[:-1], pa.int64(), mask=plain),
            pa.array(high - low, pa.int64(), mask=plain),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in OUTPUT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j in slices(batch.column(1), SLICE_BYTES):
                yield cut(doc_ids[i:j], batch.column(1).slice(i, j - i))

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, OUTPUT)


def restored(output: Column | str, form: Column | str, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text again, from an output and its form."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    before_prefix, before_suffix, before_middle = markers
    head, middle = F.substring_index(output, before_middle, 1), F.substring_index(output, before_middle, -1)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        return F.substring(F.substring_index(head, second, 1), len(first) + 1, 2**31 - 1), F.substring_index(head, second, -1)

    prefix, suffix = parts(before_prefix, before_suffix)
    late_suffix, late_prefix = parts(before_suffix, before_prefix)
    psm, spm = F.concat(prefix, middle, suffix), F.concat(late_prefix, middle, late_suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
