"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items form a suffix automaton. Training words are streamed through it, which gives
the longest matching length at every word; words inside matches of a whole window (``window`` item words in a row, or
a whole shorter item) are hit. Spans of hit words are removed when a match in them reaches ``min_match`` words, and a
document whose hit share exceeds ``max_coverage`` is removed as a whole.

Before the automaton runs, vectorised look-ups leave out words that no window can hold: those outside the items'
vocabulary and breaks between words that never follow each other in an item. The automaton's match would fall below
two words there anyway, so nothing is lost; it walks the runs that remain and are long enough for a window.

Scale: items are dealt into blocks of about ``block_words`` words by a hash of their id. A block's texts are broadcast,
and a worker process builds its automaton once and keeps the last one (about 1 KB a word), so both are bounded by the
parameter however large the benchmark is. One block (the usual case) is one map-only pass over the documents. With more,
the documents are stored once with a row number and every block is one pass over them; the hit spans of all passes are
brought together by row before ``min_match`` and ``max_coverage`` judge them, so the number of blocks changes no result.

Matches count from a whole window on: ``longest_match`` is 0 for a document that no window occurs in.

Defined cases: null and empty texts have no words and no hits; items without words match nothing; repeated rows are
treated each on their own; an empty benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.automaton import SuffixAutomaton
from granary.llm.textnp import ALNUM_TABLE, Words, slices, words_of
from granary.session import scratch_path

WINDOW = 10
BLOCK_WORDS = 300_000
MAX_COVERAGE = 0.5

RESULT = (
    "row_id long, doc_id long, n_words long, n_hit long, longest_match long, "
    "spans array<struct<first:long,end:long,longest:long>>, items array<string>, clean_text string"
)


class ItemBlock:
    """The automaton of one block of items with the vocabulary and word pairs that prune the stream."""

    def __init__(self, names: list[str], texts: list[str | None], window: int):
        words = words_of(pa.array(texts, pa.large_string()), ALNUM_TABLE)
        self.vocabulary = np.unique(words.hashes)
        ids = np.searchsorted(self.vocabulary, words.hashes)
        counts = words.counts()
        ends = np.cumsum(counts)
        items = [(name, ids[e - c : e].tolist()) for name, c, e in zip(names, counts, ends, strict=True) if c]
        self.size = np.int64(max(1, len(self.vocabulary)))
        same = words.doc[1:] == words.doc[:-1]
        self.pairs = np.unique((ids[:-1] * self.size + ids[1:])[same])
        self.min_run = min([window, *(len(w) for _, w in items)])
        self.automaton = SuffixAutomaton(items, window)
        # first check of a word: one bit for each value of its leading hash bits
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 outside the vocabulary."""
        ids = np.full(len(hashes), -1, np.int64)
        if not len(self.vocabulary):
            return ids
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == hashes[maybe]
        ids[maybe[known]] = at[known]
        return ids

    def runs(self, words: Words) -> Iterator[tuple[int, int, list[int]]]:
        """(first, end, word numbers) of the runs of words, inside one document, that can hold a window."""
        ids = self.word_ids(words.hashes)
        inside = ids >= 0
        if not inside.any():
            return
        joined = np.flatnonzero(inside[1:] & inside[:-1] & (words.doc[1:] == words.doc[:-1]))
        if len(self.pairs):
            keys = ids[joined] * self.size + ids[joined + 1]
            at = np.searchsorted(self.pairs, keys)
            at[at == len(self.pairs)] = 0
            joined = joined[self.pairs[at] == keys]
        else:
            joined = joined[:0]
        follows = np.zeros(len(ids) + 1, dtype=bool)
        follows[joined + 1] = True
        firsts = np.flatnonzero(inside & ~follows[:-1])
        breaks = np.flatnonzero(~follows[1:]) + 1
        ends = breaks[np.searchsorted(breaks, firsts + 1)]
        for k in np.flatnonzero(ends - firsts >= self.min_run):
            yield int(firsts[k]), int(ends[k]), ids[firsts[k] : ends[k]].tolist()


def _clean(words: Words, doc: int, first_word: int, spans: list[dict]) -> str:
    """Text of a document without the bytes from the first to the last word of each span."""
    begin, end = int(words.doc_offsets[doc]), int(words.doc_offsets[doc + 1])
    parts, at = [], begin
    for s in spans:
        parts.append(words.buf[at : words.starts[first_word + s["first"]]].tobytes())
        at = int(words.ends[first_word + s["end"] - 1])
    parts.append(words.buf[at:end].tobytes())
    return b"".join(parts).decode("utf-8", errors="replace")


_built: dict[str, ItemBlock] = {}


def _block(key: str, shared: Broadcast, window: int) -> ItemBlock:
    """The automaton of a broadcast block, built once in a worker process, which keeps the last one."""
    if key not in _built:
        _built.clear()
        _built[key] = ItemBlock(*shared.value, window)
    return _built[key]


def _united(spans: list[dict] | None) -> list[dict]:
    """Overlapping and touching spans as one, with the longest match in it."""
    out: list[dict] = []
    for s in sorted(spans or [], key=lambda s: (s["first"], s["end"])):
        if out and s["first"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
            out[-1]["longest"] = max(out[-1]["longest"], s["longest"])
        else:
            out.append(dict(s))
    return out


def _n_hit(united: list[dict]) -> int:
    return sum(s["end"] - s["first"] for s in united)


def _reaching(united: list[dict], min_match: int) -> list[dict]:
    return [s for s in united if s["longest"] >= min_match]


def _scan(block: ItemBlock, col: pa.Array, min_match: int, with_text: bool) -> list[tuple]:
    """Per document of a slice: n_words, n_hit, longest match, spans, items, cleaned text (None if nothing goes)."""
    words = words_of(col, ALNUM_TABLE)
    counts = words.counts()
    first_word = np.cumsum(counts) - counts
    hits: dict[int, tuple[list[dict], set[int]]] = {}
    for first, end, run in block.runs(words):
        longest, spans, found = block.automaton.run(run)
        if not found:
            continue
        doc = int(words.doc[first])
        base = first - int(first_word[doc])
        doc_spans, items = hits.setdefault(doc, ([], set()))
        doc_spans += [{"first": base + a, "end": base + b, "longest": max(longest[a:b])} for a, b in spans]
        items |= found
    out = []
    for doc in range(words.n_docs):
        if doc not in hits:
            out.append((int(counts[doc]), 0, 0, [], [], None))
            continue
        united = _united(hits[doc][0])
        spans = _reaching(united, min_match)
        text = _clean(words, doc, int(first_word[doc]), spans) if with_text and spans else None
        names = sorted(block.automaton.names[k] for k in hits[doc][1])
        out.append((int(counts[doc]), _n_hit(united), max(s["longest"] for s in united), spans, names, text))
    return out


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # before lower-casing
_ROW, _SPANS = "__decontamination_row", "__decontamination_spans"  # never names of the caller's columns
_TYPES = {
    "row_id": pa.int64(),
    "doc_id": pa.int64(),
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "longest_match": pa.int64(),
    "spans": pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("longest", pa.int64())])),
    "items": pa.list_(pa.string()),
    "clean_text": pa.string(),
}


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """The benchmark dealt into blocks of about ``block_words`` words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.regexp_count("text", F.lit(_WORD)))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) for k in range(blocks)]


def match_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_match: int = 1,
    block_words: int = BLOCK_WORDS,
    with_text: bool = False,
) -> DataFrame:
    """Hits per document row: ``row_id`` (position in the scan), counts, longest match, spans of words and items.

    ``clean_text`` is the text without the spans whose longest match reaches ``min_match``; null when none goes.
    """
    spark: SparkSession = docs.sparkSession
    blocks = item_blocks(benchmark, block_words)
    source = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    if len(blocks) == 1:
        return _match_block(spark, source, blocks[0], window, min_match, with_text)
    source = _stored(source)
    parts = [_match_block(spark, source, block, window, 1, False) for block in blocks]
    return _apply_spans(source, _unite(parts), min_match, with_text)


def _stored(numbered: DataFrame) -> DataFrame:
    """Numbered rows written once, so that every pass and the join see the same numbers."""
    path = scratch_path(numbered.sparkSession, "decontamination")
    numbered.write.parquet(path)
    return numbered.sparkSession.read.schema(numbered.schema).parquet(path)


def _unite(parts: list[DataFrame]) -> DataFrame:
    """Spans and items of each hit row over all blocks; a group has at most one row per block."""
    found = parts[0].filter("n_hit > 0")
    for part in parts[1:]:
        found = found.unionByName(part.filter("n_hit > 0"))
    return found.groupBy("row_id").agg(
        F.max("longest_match").alias("longest_match"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.flatten(F.collect_list("spans")).alias("spans"),
    )


def _match_block(spark, source: DataFrame, block: DataFrame, window: int, min_match: int, with_text: bool) -> DataFrame:
    rows = block.orderBy("item_id").collect()  # bounded by block_words
    shared = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows]))
    key = uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _block(key, shared, window)
        for batch in batches:
            for i, j in slices(batch.column(2)):
                rows = _scan(items, batch.column(2).slice(i, j - i), min_match, with_text)
                cols = [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)]
                cols += [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), list(_TYPES.values())[2:], strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=list(_TYPES))

    return source.mapInArrow(scan, RESULT)


def _apply_spans(source: DataFrame, merged: DataFrame, min_match: int, with_text: bool) -> DataFrame:
    """Counts and cleaned texts of the united spans of several blocks."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = batch.column("text"), []
            for k, spans in enumerate(batch.column("spans").to_pylist()):
                words = words_of(texts.slice(k, 1), ALNUM_TABLE)
                united = _united(spans)
                reaching = _reaching(united, min_match)
                text = _clean(words, 0, 0, reaching) if with_text and reaching else None
                rows.append((len(words.starts), _n_hit(united), reaching, text))
            n, hit, spans, text = zip(*rows, strict=True) if rows else ((), (), (), ())
            longest = batch.column("longest_match").fill_null(0)
            items = pa.array([sorted(x or []) for x in batch.column("items").to_pylist()], _TYPES["items"])
            cols = [batch.column("row_id"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), longest]
            cols += [pa.array(spans, _TYPES["spans"]), items, pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=list(_TYPES))

    return source.join(merged, "row_id", "left").mapInArrow(apply, RESULT)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_match: int = 1,
    max_coverage: float = MAX_COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents, with all their columns, that stay, and their texts without the spans.

    A document goes when more than ``max_coverage`` of its words are hit; of the others the spans go whose longest match
    reaches ``min_match``.
    """
    blocks = item_blocks(benchmark, block_words)
    if len(blocks) == 1:
        return _clean_rows(docs.sparkSession, docs, blocks[0], window, min_match, max_coverage)
    numbered = _stored(docs.select("*", F.monotonically_increasing_id().alias(_ROW)))
    source = numbered.select(F.col(_ROW).alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    united = _unite([_match_block(docs.sparkSession, source, b, window, 1, False) for b in blocks])
    spans = united.select(F.col("row_id").alias(_ROW), F.col("spans").alias(_SPANS))
    joined = numbered.join(spans, _ROW, "left").drop(_ROW)
    return joined.mapInArrow(_cut_spans(docs.columns.index("text"), min_match, max_coverage), docs.schema)


def _cut_spans(at: int, min_match: int, max_coverage: float):
    """Rows without their last column, the spans; covered rows dropped, spans cut from the text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), []
            for k, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                words = words_of(batch.column(at).slice(k, 1), ALNUM_TABLE)
                united = _united(spans)
                keep.append(_n_hit(united) <= max_coverage * len(words.starts))
                if reaching := _reaching(united, min_match):
                    texts[k] = _clean(words, 0, 0, reaching)
            out = batch.select(list(range(batch.num_columns - 1)))
            out = out.set_column(at, out.schema.field(at), pa.array(texts, out.schema.field(at).type))
            yield out.filter(pa.array(keep, pa.bool_()))

    return apply


def _clean_rows(spark, docs: DataFrame, block: DataFrame, window: int, min_match: int, max_coverage: float) -> DataFrame:
    """Rows of ``docs`` with all their columns: covered ones dropped, ``text`` without its spans."""
    rows = block.orderBy("item_id").collect()  # bounded by block_words
    shared = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows]))
    key = uuid.uuid4().hex
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _block(key, shared, window)
        for batch in batches:
            for i, j in slices(batch.column(at)):
                part = batch.slice(i, j - i)
                found = _scan(items, part.column(at), min_match, True)
                texts = part.column(at).to_pylist() if any(f[5] is not None for f in found) else None
                if texts is not None:
                    texts = [t if f[5] is None else f[5] for t, f in zip(texts, found, strict=True)]
                    part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
                yield part.filter(pa.array([f[1] <= max_coverage * f[0] for f in found], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
