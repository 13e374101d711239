"""Language identification by rank-order n-gram profiles.

A profile lists a text's or a language's most frequent n-grams (1 to 3 letters, words padded by a blank) by rank. A
document's distance to a language is the sum over its profile of how far each n-gram is out of place, with
``PROFILE`` for an n-gram that the language's profile lacks; the nearest language is predicted. The score is 1 minus
the distance as a share of the largest possible one.

N-grams are exact (code points packed into a long), counted by sorting. Training sums counts map-side and ranks
them per language with a window of which only the first ``PROFILE`` rows leave each task. The languages' profiles,
``PROFILE`` rows for each of at most ``MAX_LANGUAGES`` languages (checked), are broadcast; scoring is map-only.

Defined cases: a null text or one without letters is ``und`` with score 0; so is everything when no language was
learned; ties of count or distance go to the smaller n-gram or language name; rows without a language are not learned
from; a null id is not held out; repeated rows and long texts need no special case; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from granary.llm.textnp import slices

PROFILE = 300
MAX_LANGUAGES = 2_000
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
HELD_OUT_FOLDS, HELD_OUT_FOLD = 4, 2

_PAD = 1  # an n-gram's symbols: 0 none, 1 the blank around words, else the letter's code point
_BITS = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, one blank after each, and their documents."""
    lowered = [(t or "").lower() + "\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", errors="replace"), np.uint32).astype(np.int64)
    return codes, np.repeat(np.arange(len(texts)), np.fromiter(map(len, lowered), np.int64, len(lowered)))


def ngram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram, count), by document and n-gram, of all n-grams of a slice of documents."""
    codes, doc = _code_points(texts)
    letter = _letters()[codes]
    # blanks: one after every word; what else is no letter is left out
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    symbols, doc = np.where(letter, codes, _PAD)[keep], doc[keep]
    if not len(symbols):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    alphabet, own = np.unique(symbols, return_inverse=True)
    own = own + 1  # 0: none
    bits = int(len(alphabet) + 1).bit_length()
    before = np.concatenate([[1], own[:-1]])  # the blank has the lowest symbol, and so number 1
    after = np.concatenate([own[1:], [1]])
    if alphabet[0] != _PAD:
        raise AssertionError("every text ends with a blank")
    inside = symbols != _PAD
    # n-grams around each letter: itself; with the one before and, at a word's end, the blank after; and all three
    a, b, c, d = before[inside], own[inside], after[inside], doc[inside]
    ends = c == 1
    grams = np.concatenate([b << 2 * bits, (a << 2 * bits) | (b << bits), ((b << 2 * bits) | (c << bits))[ends], (a << 2 * bits) | (b << bits) | c])
    docs = np.concatenate([d, d, d[ends], d])
    if 3 * bits + int(len(texts)).bit_length() <= 63:
        key = np.sort((docs << (3 * bits)) | grams)
        docs, grams = key >> (3 * bits), key & ((1 << 3 * bits) - 1)
    else:
        order = np.lexsort((grams, docs))
        docs, grams = docs[order], grams[order]
    first = np.ones(len(grams), bool)
    first[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(grams)))
    symbol = np.concatenate([[0], alphabet])
    mask = (1 << bits) - 1
    grams = grams[at]
    packed = (symbol[grams >> 2 * bits] << 2 * _BITS) | (symbol[(grams >> bits) & mask] << _BITS) | symbol[grams & mask]
    return docs[at], packed, counts


def _ranked(doc: np.ndarray, grams: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, n-gram, rank) of each document's ``size`` most frequent n-grams."""
    # n-grams come in order within a document, so equal counts stay in that order
    if len(doc) and int(doc[-1]).bit_length() + int(counts.max()).bit_length() + int(len(doc)).bit_length() <= 62:
        width, top = int(len(doc)).bit_length(), int(counts.max())
        key = np.sort((((doc << top.bit_length()) | (top - counts)) << width) | np.arange(len(doc)))
        order = key & ((1 << width) - 1)
    else:
        order = np.lexsort((-counts, doc))
    doc, grams = doc[order], grams[order]
    starts = np.searchsorted(doc, doc, side="left")
    rank = np.arange(len(doc)) - starts
    keep = rank < size
    return doc[keep], grams[keep], rank[keep]


def language_counts(rows: DataFrame) -> DataFrame:
    """(``lang``, ``gram``, ``n``) over all rows of (``lang``, ``text``), summed per task before they leave it."""
    limit = 500_000  # distinct n-grams that a task holds before it hands them on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def emit() -> pa.RecordBatch:
            names = np.repeat(list(sums), [len(g) for g, _ in sums.values()]) if sums else []
            grams = np.concatenate([g for g, _ in sums.values()]) if sums else np.empty(0, np.int64)
            counts = np.concatenate([n for _, n in sums.values()]) if sums else np.empty(0, np.int64)
            out = [pa.array(names, pa.string()), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())]
            return pa.RecordBatch.from_arrays(out, names=["lang", "gram", "n"])

        for batch in batches:
            for i, j in slices(batch.column(1), SLICE_BYTES):
                langs = np.array(batch.column(0).slice(i, j - i).to_pylist(), object)
                doc, grams, counts = ngram_counts(batch.column(1).slice(i, j - i).to_pylist())
                for lang in sorted(set(langs)):
                    own = (langs == lang)[doc]
                    held, n = sums.get(lang, (np.empty(0, np.int64), np.empty(0, np.int64)))
                    every, at = np.unique(np.concatenate([held, grams[own]]), return_inverse=True)
                    total = np.bincount(at, np.concatenate([n, counts[own]]), minlength=len(every)).astype(np.int64)
                    sums[lang] = (every, total)
                if sum(len(g) for g, _ in sums.values()) > limit:
                    yield emit()
                    sums.clear()
        yield emit()

    counted = rows.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(rows: DataFrame, size: int = PROFILE) -> DataFrame:
    """Profiles of the languages of (``lang``, ``text``) rows: ``lang``, ``gram``, ``rank``."""
    order = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    counts = language_counts(rows).withColumn("place", F.row_number().over(order))
    # the plain row number is what a limit per task (WindowGroupLimit) is inferred from
    return counts.filter(F.col("place") <= size).select("lang", "gram", (F.col("place") - 1).cast("int").alias("rank"))


class Profiles:
    """Ranks of all profile n-grams in every language, for look-up."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({lang for lang, _, _ in rows})
        self.grams = np.unique(np.array([g for _, g, _ in rows], np.int64))
        number = {lang: k for k, lang in enumerate(self.langs)}
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)  # the last row: n-grams of no language
        at = np.searchsorted(self.grams, [g for _, g, _ in rows])
        self.ranks[at, [number[lang] for lang, _, _ in rows]] = [r for _, _, r in rows]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) per text."""
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        doc, grams, rank = _ranked(*ngram_counts(texts), self.size)
        if not len(doc) or not self.langs:
            return names, scores
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        known = self.ranks[at]
        away = np.where(known < 0, self.size, np.abs(known - rank[:, None].astype(np.int32)))
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        distance = np.add.reduceat(away, first, axis=0, dtype=np.int64)
        best = distance.argmin(axis=1)
        number = np.diff(np.append(first, len(doc)))
        scores[doc[first]] = 1 - distance[np.arange(len(first)), best] / (number * self.size)
        for d, k in zip(doc[first].tolist(), best.tolist(), strict=True):
            names[d] = self.langs[k]
        return names, scores


def fold(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def identify(docs: DataFrame, profiles: DataFrame, size: int = PROFILE) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every document."""
    spark = docs.sparkSession
    rows = profiles.limit(size * MAX_LANGUAGES + 1).collect()
    if len(rows) > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: their profiles are not broadcast")
    shared = spark.sparkContext.broadcast(Profiles([(r["lang"], r["gram"], r["rank"]) for r in rows], size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(1), SLICE_BYTES):
                names, scores = shared.value.predict(batch.column(1).slice(i, j - i).to_pylist())
                cols = [batch.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang_pred", "score"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double")


def training_rows(docs: DataFrame) -> DataFrame:
    """``lang`` and ``text`` of the documents that are learned from."""
    learned = (fold(F.col("doc_id"), HELD_OUT_FOLDS) != HELD_OUT_FOLD) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    return docs.filter(learned).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
