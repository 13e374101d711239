"""Hierarchical Pitman-Yor language model over one-word contexts, trained and applied across shards of words.

A word's restaurant is that of its context, the word before it, known by its 56-bit hash: there are as many restaurants
as the training texts have words. They all share one parent, the restaurant of single words, whose parent is uniform
over the V known words and one for all others:

    P(w | k) = (c_kw - d t_kw + (a + d T_k) P(w)) / (a + C_k),   and likewise P(w) over 1 / (V + 1)

with customers c, tables t, their sums C and T per restaurant, discount d and strength a of the level. A child's tables
are its parent's customers. Seating is sampled by Gibbs in blocks: a sweep re-seats the customers of every dish, given
all others, by drawing its number of tables (what prediction needs of a seating) from the exact conditional with
generalised Stirling numbers; dishes of more than ``EXACT`` customers are seated in turn, in growing groups (an
approximation; their tables are few next to their customers, so it hardly shows in the probabilities). Probabilities are
averaged over the sweeps after ``BURN_IN``. Discounts come from counts of counts.

Distribution: everything about a word lives in its shard, chosen by the word's hash; the sums C and T of a context live
in the shard of the context's hash, its owner. Shards take part in a sweep at the same time with the sums of the sweep
before (as in approximate distributed Gibbs samplers). After it each shard hands its tables, added up per context, to
the owners, and each owner hands the new totals back to the shards that have the context: stored tables, two shuffles a
sweep, nothing that grows with the words is broadcast or collected. A context is one number per shard at most, so a hot
one weighs no more than any other. A sweep's random numbers hang on the shard and the sweep alone, so any pass can
replay the seating from the sums, and lost tasks repeat it; only the seatings that prediction needs are stored.

Data: training counts are combined per task, packed (sorted hashes as differences, compressed) and shuffled by
shard. For scoring, tasks pack their documents' distinct words and word pairs by shard; shards answer with the counts
of each word, each pair and, as owners, each context, and the answers meet the batch of documents that they belong to.
The number of shards follows the size of the texts; a shard with hot words is answered in as many parts as its tokens
ask for, each with its own copy of the shard's model.

Words are identified by 56-bit hashes. Defined cases: null and empty texts are the end token alone; without training
rows all words are unknown; an empty table has an empty result; a null id counts as fold 0; repeated rows are texts of
their own; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.textnp import slices, space_table, words_of
from granary.session import delete_folder, scratch_path

CONTEXTS = 1 << 32  # radix of the keys (word number, context number) in a shard; no limit to the contexts of a corpus
BURN_IN = 1
SAMPLES = 2
STRENGTH = 1.0
EXACT = 256  # customers of a dish up to which Stirling numbers are used
GROWTH = 1.05  # of the groups in which larger dishes are seated
MIN_SHARDS = 32
SHARD_TOKENS = 16_000_000
BATCH_TOKENS = 1_000_000
SEED = 7

# Words are told apart by the first 56 bits of their hashes: the last byte is zero and packs to nothing.
_HASH_BITS = ~np.uint64(0xFF)
END = np.uint64(0x5DEECE66D1CE4E5B) & _HASH_BITS
_TABLE = space_table(lower=True)


# -- packing ----------------------------------------------------------------------------------------------------------


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block; those named ``*_sorted`` are kept as differences (that wrap around, so any array may be)."""
    press = zstandard.ZstdCompressor(level=1)
    head, parts = {}, []
    for name, values in arrays.items():
        values = np.diff(values, prepend=values.dtype.type(0)) if name.endswith("_sorted") else values
        # the bytes of equal weight next to each other compress better
        planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
        parts.append(press.compress(planes.tobytes()))
        head[name] = [values.dtype.str, len(values), len(parts[-1])]
    header = json.dumps(head).encode()
    return b"".join([struct.pack("<I", len(header)), header, *parts])


def unpack(block: bytes) -> dict[str, np.ndarray]:
    (size,) = struct.unpack("<I", block[:4])
    at, out = 4 + size, {}
    for name, (kind, n, length) in json.loads(block[4:at]).items():
        raw = zstandard.ZstdDecompressor().decompress(block[at : at + length], max_output_size=max(1, n * np.dtype(kind).itemsize))
        planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, n)
        values = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        out[name] = np.cumsum(values, dtype=values.dtype) if name.endswith("_sorted") else values
        at += length
    return out


def small(values: np.ndarray) -> np.ndarray:
    """The values in the least unsigned type that holds them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


# -- tokens -----------------------------------------------------------------------------------------------------------


@dataclass
class Tokens:
    """Word hash of every token, the end tokens included, and tokens per document. A token's context is the token before
    it; that of a document's first token is an end token, as each document ends with one."""

    words: np.ndarray
    counts: np.ndarray


def tokens_of(col: pa.Array) -> Tokens:
    words = words_of(col, _TABLE)
    counts = words.counts()
    return Tokens(np.insert(words.hashes & _HASH_BITS, np.cumsum(counts), END), counts + 1)


def batches_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list, Tokens]]:
    """(first column of the documents, their tokens) of about ``BATCH_TOKENS`` tokens each."""
    ids: list = []
    held: list[Tokens] = []

    def joined() -> tuple[list, Tokens]:
        return ids, Tokens(np.concatenate([t.words for t in held]), np.concatenate([t.counts for t in held]))

    for batch in batches:
        for i, j in slices(batch.column(column)):
            ids = ids + batch.column(0).slice(i, j - i).to_pylist()
            held.append(tokens_of(batch.column(column).slice(i, j - i)))
            if sum(len(t.words) for t in held) >= BATCH_TOKENS:
                yield joined()
                ids, held = [], []
    if held:
        yield joined()


def _shard_ranges(words: np.ndarray, shards: int) -> np.ndarray:
    """Bounds of each shard in sorted word hashes; a shard is named by the leading bits."""
    bits = np.uint64(64 - (shards - 1).bit_length()) if shards > 1 else np.uint64(63)
    starts = np.arange(1, shards, dtype=np.uint64) << bits
    return np.concatenate([[0], np.searchsorted(words, starts), [len(words)]])


# -- counts -----------------------------------------------------------------------------------------------------------


def _starts(key: np.ndarray) -> np.ndarray:
    """Where each value of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)


def _coded(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words ascending, number of the word of each token)."""
    distinct, code = np.unique(tokens.words, return_inverse=True)
    return distinct, code.astype(np.int64)


def _pair_keys(distinct: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Word number and context number of each token as one number."""
    before = np.concatenate([[np.searchsorted(distinct, END)], code[:-1]])
    return code * CONTEXTS + before


def _pairs_by_shard(distinct: np.ndarray, key: np.ndarray, shards: int) -> Iterator[tuple[int, int, int, dict[str, np.ndarray]]]:
    """(shard, its bounds in the pairs, words and pairs) of each shard that has some of the ascending distinct ``key``s.
    A shard's contexts are numbers in its own list of hashes."""
    bounds = _shard_ranges(distinct, shards)
    pairs = np.bincount(key // CONTEXTS, minlength=len(distinct))
    ends = np.concatenate([[0], np.cumsum(pairs)])
    for shard in range(shards):
        a, b = bounds[shard], bounds[shard + 1]
        if a < b:
            p, q = ends[a], ends[b]
            own, number = np.unique(key[p:q] % CONTEXTS, return_inverse=True)
            yield shard, p, q, {"words_sorted": distinct[a:b], "pairs": small(pairs[a:b]), "known_sorted": distinct[own], "contexts_sorted": small(number)}


_PACKED = "shard int, part int, kind int, block binary"


def _rows(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return _rows(rows, ["shard", "part", "kind", "block"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()])


def packed_counts(texts: DataFrame, shards: int) -> DataFrame:
    """Combined counts of (word, context) pairs of the training texts, packed by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens in batches_of(batches, 0):
            distinct, code = _coded(tokens)
            key = np.sort(_pair_keys(distinct, code))
            first = _starts(key)
            counts = np.diff(np.append(first, len(key)))
            out = [(shard, 0, 0, pack(**x, counts=small(counts[p:q]))) for shard, p, q, x in _pairs_by_shard(distinct, key[first], shards)]
            yield _packed(out)

    return texts.mapInArrow(run, _PACKED)


_SHARD = "shard int, names binary, model binary, tokens long, words long, pairs long, pair_ones long, pair_twos long, word_ones long, word_twos long"


def _merge(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Blocks of (words, pairs per word, hashes of contexts, contexts by number, counts) as one."""
    distinct = np.unique(np.concatenate([w for w, *_ in held]))
    known = np.unique(np.concatenate([k for _, _, k, _, _ in held]))
    if len(known) > CONTEXTS:
        raise ValueError("more contexts in a shard than its keys can tell apart")
    key = np.concatenate([np.repeat(np.searchsorted(distinct, w) * CONTEXTS, n) + np.searchsorted(known, k)[c] for w, n, k, c, _ in held])
    counts = np.concatenate([n for *_, n in held]).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = _starts(key)
    sums = np.add.reduceat(counts[order], first) if len(key) else counts
    key = key[first]
    return distinct, np.bincount(key // CONTEXTS, minlength=len(distinct)), known, small(key % CONTEXTS), sums


def shard_models(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its merged counts and what the sums over all shards need of them."""

    def row(shard: int, held: list) -> tuple:
        words, pairs, known, contexts, n = _merge(held)
        names = pack(words_sorted=words, known_sorted=known)  # sweeps do without
        model = pack(pairs=small(pairs), contexts_sorted=contexts, counts=small(n), bounds=_shard_ranges(known, shards))
        ones = [int((x == k).sum()) for x in (n, pairs) for k in (1, 2)]
        return shard, names, model, int(n.sum()), len(words), len(n), *ones

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SHARD.split(", ")]
        kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7]
        current, held = None, []
        for batch in batches:
            for shard, block in zip(batch.column(0).to_pylist(), batch.column(3), strict=True):
                if shard != current and held:
                    yield _rows([row(current, held)], names, kinds)
                    held = []
                current = shard
                x = unpack(block.as_py())
                held.append((x["words_sorted"], x["pairs"].astype(np.int64), x["known_sorted"], x["contexts_sorted"], x["counts"]))
                if len(held) > 1 and sum(len(h[3]) for h in held[1:]) > max(1_000_000, len(held[0][3])):
                    held = [_merge(held)]
        if held:
            yield _rows([row(current, held)], names, kinds)

    return counts.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, _SHARD)


# -- seating ----------------------------------------------------------------------------------------------------------


@dataclass
class Sums:
    """What a sweep knows of the parent: its customers and tables."""

    customers1: int
    tables1: int


@dataclass
class Corpus:
    tokens: int
    words: int
    discount: float
    discount1: float
    rounds: list[Sums] = field(default_factory=list)  # the first: one table per dish; then after each sweep

    def parent(self, sums: Sums, customers1: np.ndarray, tables1: np.ndarray) -> np.ndarray:
        """Probabilities in the parent restaurant of words with so many customers and tables (0 for words of no text)."""
        new = (STRENGTH + self.discount1 * sums.tables1) / (self.words + 1)
        return (customers1 - self.discount1 * tables1 + new) / (STRENGTH + sums.customers1)

    def log_scores(self, own: np.ndarray, by_word: list[np.ndarray], word: np.ndarray, by_context: list[np.ndarray], context: np.ndarray) -> np.ndarray:
        """log10 P of pairs, from their means of c - d t, the samples' parent probabilities of words, and C and the
        samples' T of contexts."""
        customers, *tables = by_context
        back = sum((STRENGTH + self.discount * t[context]) * p[word] for t, p in zip(tables, by_word, strict=True)) / SAMPLES
        return np.log10((own + back) / (STRENGTH + customers[context]))


@lru_cache(maxsize=8)
def stirling(discount: float, size: int = EXACT) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: [c, t] for c customers at t tables."""
    table = np.full((size + 1, size + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(size):
        t = np.arange(1, c + 2)
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + table[c, 1 : c + 2]
        table[c + 1, 1 : c + 2] = np.logaddexp(table[c, : c + 1], stay)
    return table


def draw_tables(c: np.ndarray, tables: np.ndarray, rest: np.ndarray, p: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """New numbers of tables of dishes with ``c`` customers, given the parent's probability ``p`` of the dish and the
    ``rest`` of the restaurant's tables. ``tables`` gives what dishes of one customer keep."""
    out = tables.copy()
    log_p = np.log(p)
    table = stirling(discount)
    many = np.flatnonzero((c > 1) & (c <= EXACT))
    many = many[np.argsort(c[many], kind="stable")]
    for part in np.split(many, np.flatnonzero(np.diff(c[many])) + 1) if len(many) else []:
        n = int(c[part[0]])
        step = max(1, 500_000 // n)
        for at in range(0, len(part), step):
            own = part[at : at + step]
            seats = np.log(STRENGTH + discount * (rest[own, None] + np.arange(n)))  # opening one more table
            weight = table[n, 1 : n + 1] + np.arange(1, n + 1) * log_p[own, None] + np.cumsum(seats, axis=1)
            weight = np.exp(weight - weight.max(axis=1, keepdims=True))
            cut = np.cumsum(weight, axis=1)
            out[own] = 1 + (cut < rng.random((len(own), 1)) * cut[:, -1:]).sum(axis=1)
    large = np.flatnonzero(c > EXACT)
    if len(large):
        n, t = np.ones(len(large)), np.ones(len(large))
        while (open_ := n < c[large]).any():
            group = np.where(open_, np.minimum(c[large] - n, np.maximum(1, np.floor(n * (GROWTH - 1)))), 0)
            new = (STRENGTH + discount * (rest[large] + t)) * p[large]
            t += rng.binomial(group.astype(np.int64), np.clip(new / (new + n - discount * t), 0, 1))
            n += group
        out[large] = t.astype(np.int64)
    return out


class Seating:
    """Counts of a shard and the seating that its sweeps reach."""

    def __init__(self, shard: int, block: bytes, corpus: Corpus):
        x = unpack(block)
        self.shard, self.corpus, self.bounds = shard, corpus, x["bounds"]
        self.pairs = x["pairs"].astype(np.int64)
        self.contexts = x["contexts_sorted"].astype(np.int64)
        self.counts = x["counts"].astype(np.int64)
        self.first = np.cumsum(self.pairs) - self.pairs
        self.word_of = np.repeat(np.arange(len(self.pairs)), self.pairs)
        self.tables = np.ones(len(self.counts), np.int64)
        self.tables1 = np.ones(len(self.pairs), np.int64)

    def customers1(self) -> np.ndarray:
        return np.add.reduceat(self.tables, self.first) if len(self.first) else np.empty(0, np.int64)

    def sweep(self, number: int, tables: np.ndarray) -> None:
        """Re-seat every dish, given the sums before the sweep (``tables``: those of the shard's contexts)."""
        sums = self.corpus.rounds[number]
        rng = np.random.default_rng([SEED, self.shard, number])
        p = self.corpus.parent(sums, self.customers1(), self.tables1)
        rest = np.maximum(tables[self.contexts] - self.tables, 0)
        self.tables = draw_tables(self.counts, self.tables, rest, p[self.word_of], self.corpus.discount, rng)
        base = np.full(len(self.pairs), 1 / (self.corpus.words + 1))
        rest1 = np.maximum(sums.tables1 - self.tables1, 0)
        self.tables1 = np.minimum(self.tables1, self.customers1())
        self.tables1 = np.where(self.customers1() == 1, 1, self.tables1)
        self.tables1 = draw_tables(self.customers1(), self.tables1, rest1, base, self.corpus.discount1, rng)

    def context_sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.contexts, values, minlength=self.bounds[-1]).astype(np.int64)


class ShardModel:
    """What scoring needs of a shard: its counts, its sampled seatings and the sums of the contexts that it owns."""

    def __init__(self, shard: int, block: bytes, corpus: Corpus):
        self.shard, self.block, self.corpus = shard, unpack(block), corpus

    def predictive(self) -> "Predictive":
        x = self.block
        pairs = x["pairs"].astype(np.int64)
        counts = x["counts"].astype(np.int64)
        first = np.cumsum(pairs) - pairs
        word_counts = np.add.reduceat(counts, first) if len(first) else np.empty(0, np.int64)
        by_word = [word_counts, *(x[f"{k}{s}"].astype(np.int64) for s in range(SAMPLES) for k in ("customers1_", "tables1_"))]
        by_context = [x["customers"].astype(np.int64), *(x[f"owned_tables{s}"].astype(np.int64) for s in range(SAMPLES))]
        keys = np.repeat(np.arange(len(pairs)), pairs) * CONTEXTS + x["contexts_sorted"].astype(np.int64)
        return Predictive(x["words_sorted"], x["known_sorted"], keys, counts, x["seated"].astype(np.int64), by_word, x["owned_sorted"], by_context, self.corpus)


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Number of each value in an ascending table; -1 if it has none."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return np.where(table[at] == values, at, -1)


@dataclass
class Predictive:
    words: np.ndarray
    known: np.ndarray  # hashes of the contexts that the shard's words occur in
    keys: np.ndarray  # word number and context number of each pair, ascending
    counts: np.ndarray  # customers of each pair
    seated: np.ndarray  # tables of each pair, added up over the samples
    by_word: list[np.ndarray]  # count of each word, then its customers and tables in the parent in each sample
    owned: np.ndarray  # hashes of the contexts whose sums the shard holds
    by_context: list[np.ndarray]  # their customers, then tables in each sample
    corpus: Corpus

    def of_pairs(self, number: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers of pairs, and tables added up over the samples, by word and context number (-1: none)."""
        at = np.where((number >= 0) & (context >= 0), _find(self.keys, number * CONTEXTS + context), -1)
        return np.append(self.counts, 0)[at], np.append(self.seated, 0)[at]

    def look_up(self, words: np.ndarray, times: np.ndarray, known: np.ndarray, contexts: np.ndarray) -> dict[str, np.ndarray]:
        """All that the shard holds of the pairs (contexts by number in ``known``), the words, and the words as contexts."""
        number = _find(self.words, words)
        counts, seated = self.of_pairs(np.repeat(number, times), _find(self.known, known)[contexts])
        out = {"counts": small(counts), "seated": small(seated)}
        out |= {f"word{k}": small(np.append(x, 0)[number]) for k, x in enumerate(self.by_word)}
        owned = _find(self.owned, words)
        return out | {f"context{k}": small(np.append(x, 0)[owned]) for k, x in enumerate(self.by_context)}

    def answer(self, words: np.ndarray, times: np.ndarray, contexts: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, sum of log10 P, sum of log10 (c + 1), known tokens) for tokens by word and context number, if the
        shard owns their contexts."""
        x = self.look_up(words, times, self.known, contexts)
        owned = _find(self.owned, self.known)
        by_context = [np.append(v, 0)[owned] for v in self.by_context]
        by_word = [x[f"word{k}"] for k in range(len(self.by_word))]
        score, base, known = judged(self.corpus, x["counts"], x["seated"], by_word, np.repeat(np.arange(len(words)), times), by_context, contexts)
        docs, local = np.unique(doc, return_inverse=True)
        return docs, np.bincount(local, score), np.bincount(local, base), np.bincount(local, known).astype(np.int64)


def judged(corpus: Corpus, counts, seated, by_word: list, word, by_context: list, context) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """log10 P, log10 (c + 1) and whether the word is known, of pairs, from what the shards hold of pairs, words and
    contexts."""
    own = counts - corpus.discount * seated.astype(np.float64) / SAMPLES
    samples = [corpus.parent(corpus.rounds[BURN_IN + s + 1], by_word[2 * s + 1].astype(np.float64), by_word[2 * s + 2]) for s in range(SAMPLES)]
    score = corpus.log_scores(own, samples, word, [x.astype(np.float64) for x in by_context], context)
    return score, np.log10(by_word[0] + 1.0)[word], (by_word[0] > 0)[word]


# -- training and scoring ---------------------------------------------------------------------------------------------


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def number_of_shards(docs: DataFrame) -> int:
    """A power of two; shards hold about ``SHARD_TOKENS`` tokens, of six characters with what parts them."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(MIN_SHARDS, 1 << math.ceil(math.log2(max(1, chars / 6 / SHARD_TOKENS))))


_MET = "key int, other int, kind int, block binary, customers1 long, tables1 long"
_LIST, _INDEX, _TABLES = 0, 1, 2  # to owners: a shard's contexts, where they are in the owner's, and their tables
_TO_SHARD, _OWNED, _TOTALS, _FINAL = 3, 4, 5, 6  # to shards: totals of a shard's contexts, and what scoring needs


def _met(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r if len(r) == 6 else (*r, 0, 0) for r in rows]
    return _rows(rows, [c.split()[0] for c in _MET.split(", ")], [*[pa.int32()] * 3, pa.binary(), pa.int64(), pa.int64()])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows by their first column, which they are sorted by."""
    current, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != current and held:
                yield current, held
                held = []
            current = row[0]
            held.append(row[1:])
    if held:
        yield current, held


def _to_owners(shard: int, bounds: np.ndarray, kind: int, **values: np.ndarray) -> list[tuple]:
    """A shard's context hashes or sums, cut up for the contexts' owners."""
    pieces = [(owner, bounds[owner], bounds[owner + 1]) for owner in range(len(bounds) - 1)]
    return [(owner, shard, kind, pack(**{k: v[a:b] if k.endswith("_sorted") else small(v[a:b]) for k, v in values.items()})) for owner, a, b in pieces if a < b]


class _Stored:
    """A stored table between two steps. What the steps before it have shuffled is freed when it is written."""

    def __init__(self, frame: DataFrame, name: str, columns: str):
        self.spark = frame.sparkSession
        self.path = scratch_path(self.spark, f"pitman-yor-{name}")
        frame.write.parquet(self.path)
        self.spark._jvm.System.gc()  # the context cleaner deletes files of shuffles that the driver no longer holds
        self.rows = self.spark.read.schema(columns).parquet(self.path)

    def delete(self) -> None:
        delete_folder(self.spark, self.path)


def _by_owner(frame: DataFrame) -> DataFrame:
    """The totals of all contexts, for their owners and for the shards that have them, from the shards' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for owner, rows in _groups(batches):
            if rows[0][1] == _LIST:  # the first round
                blocks = [(shard, unpack(block)) for shard, _, block in rows]
                owned = np.unique(np.concatenate([x["known_sorted"] for _, x in blocks]))
                places = {shard: np.searchsorted(owned, x["known_sorted"]) for shard, x in blocks}
                customers = np.zeros(len(owned), np.int64)
                for shard, x in blocks:
                    customers[places[shard]] += x["customers"].astype(np.int64)
                yield _met([(owner, 0, _OWNED, pack(owned_sorted=owned, customers=small(customers)))])
                yield _met([(owner, shard, _INDEX, pack(at_sorted=at)) for shard, at in places.items()])
                tables = {shard: x["tables"] for shard, x in blocks}
            else:
                places = {shard: unpack(block)["at_sorted"] for shard, kind, block in rows if kind == _INDEX}
                tables = {shard: unpack(block)["tables"] for shard, kind, block in rows if kind == _TABLES}
            totals = np.zeros(1 + max(int(at[-1]) for at in places.values()), np.int64)
            for shard, at in places.items():
                totals[at] += tables[shard].astype(np.int64)
            yield _met([(owner, 0, _TOTALS, pack(tables=small(totals)))])
            for shard, at in places.items():
                yield _met([(shard, owner, _TO_SHARD, pack(tables=small(totals[at])))])

    met = frame.select("key", "other", "kind", "block").repartition("key").sortWithinPartitions("key", "kind", "other")
    return met.mapInArrow(run, _MET)


def _swept(models: DataFrame, rounds: list[DataFrame], corpus: Corpus) -> DataFrame:
    """One more sweep of all shards: their tables for the owners, and after the last sweep what scoring needs."""
    shared = models.sparkSession.sparkContext.broadcast(corpus)  # a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(shared.value.rounds) - 1
        for shard, rows in _groups(batches):
            model = Seating(shard, rows[0][2], shared.value)
            final, seated = {}, np.zeros(len(model.counts), np.int64)
            for number in range(last + 1):
                model.sweep(number, np.concatenate([unpack(block)["tables"] for round_, _, block in rows if round_ == number]).astype(np.int64))
                if number >= BURN_IN:
                    seated += model.tables
                    final |= {f"customers1_{number - BURN_IN}": small(model.customers1()), f"tables1_{number - BURN_IN}": small(model.tables1)}
            if last == BURN_IN + SAMPLES - 1:
                yield _met([(shard, 0, _FINAL, pack(**final, seated=small(seated)))])
            yield _met([(shard, 0, -1, b"", int(model.customers1().sum()), int(model.tables1.sum()))])
            yield _met(_to_owners(shard, model.bounds, _TABLES, tables=model.context_sums(model.tables)))

    met = models.select("shard", F.lit(-1).alias("round"), F.lit(0).alias("owner"), F.col("model").alias("block"))
    for number, sums in enumerate(rounds):
        to_shard = sums.filter(F.col("kind") == _TO_SHARD)
        met = met.unionByName(to_shard.select(F.col("key").alias("shard"), F.lit(number).alias("round"), F.col("other").alias("owner"), "block"))
    return met.repartition("shard").sortWithinPartitions("shard", "round", "owner").mapInArrow(run, _MET)


def train(texts: DataFrame, shards: int) -> tuple[DataFrame, Corpus]:
    """The shards' models (a stored table) and the sums over the whole corpus, from a column of texts."""
    stored = [_Stored(shard_models(packed_counts(texts, shards), shards), "shards", _SHARD)]
    models = stored[0].rows
    names = ["tokens", "words", "pairs", "pair_ones", "pair_twos", "word_ones", "word_twos"]
    n = {k: v or 0 for k, v in models.agg(*(F.sum(c).alias(c) for c in names)).first().asDict().items()}
    corpus = Corpus(n["tokens"], n["words"], _discount(n["pair_ones"], n["pair_twos"]), _discount(n["word_ones"], n["word_twos"]))
    corpus.rounds.append(Sums(n["pairs"], n["words"]))  # at first every dish has one table

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, names_, block in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                x = Seating(shard, block.as_py(), corpus)
                sums = {"customers": x.context_sums(x.counts), "tables": x.context_sums(x.tables)}
                yield _met(_to_owners(shard, x.bounds, _LIST, known_sorted=unpack(names_.as_py())["known_sorted"], **sums))

    stored.append(_Stored(_by_owner(models.select("shard", "names", "model").mapInArrow(lists, _MET)), "sums", _MET))
    rounds = [stored[-1].rows]
    index = rounds[0].filter(F.col("kind") == _INDEX)
    for _ in range(BURN_IN + SAMPLES):
        stored.append(_Stored(_swept(models, rounds, corpus), "sweep", _MET))
        swept = stored[-1].rows
        total = swept.agg(F.sum("customers1").alias("c"), F.sum("tables1").alias("t")).first()
        stored.append(_Stored(_by_owner(swept.filter(F.col("kind") == _TABLES).unionByName(index)), "sums", _MET))
        rounds.append(stored[-1].rows)
        corpus.rounds.append(Sums(total["c"] or 0, total["t"] or 0))
    parts = [models.select(F.col("shard").alias("key"), F.lit(0).alias("other"), F.lit(_FINAL).alias("kind"), F.col(c).alias("block")) for c in ("names", "model")]
    parts += [x.select("key", "other", "kind", "block") for x in (swept.filter(F.col("kind") == _FINAL), rounds[0].filter(F.col("kind") == _OWNED))]
    for s, sums in enumerate(rounds[BURN_IN + 1 :]):
        parts.append(sums.filter(F.col("kind") == _TOTALS).select("key", F.lit(s).alias("other"), "kind", "block"))
    final = _Stored(_models(parts), "models", _MODELS)
    for x in stored:
        x.delete()
    return final.rows, corpus


_MODELS = "shard int, model binary, tokens long"


def _models(parts: list[DataFrame]) -> DataFrame:
    """One row per shard with all that scoring needs of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _groups(batches):
            model: dict[str, np.ndarray] = {}
            for other, kind, block in rows:
                x = unpack(block)
                model |= {f"owned_tables{other}": x["tables"]} if kind == _TOTALS else x
            yield _rows([(shard, pack(**model), int(model["counts"].sum(dtype=np.int64)))], ["shard", "model", "tokens"], [pa.int32(), pa.binary(), pa.int64()])

    met = reduce(DataFrame.unionByName, parts)
    return met.repartition("key").sortWithinPartitions("key").mapInArrow(run, _MODELS)


_MODEL, _REQUEST, _HEADER = 0, 1, 2
_ANSWER = "batch long, shard int, block binary"
_SCORED = "doc_id long, n_tokens long, n_known long, base_sum double, score double"


def score(docs: DataFrame, models: DataFrame, corpus: Corpus, shards: int) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_sum`` (of log10 (c + 1)) and ``score`` of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(corpus)
    sizes = {r["shard"]: r["tokens"] for r in models.select("shard", "tokens").collect()}  # one row per shard
    parts = [max(1, math.ceil(sizes.get(s, 0) / SHARD_TOKENS)) for s in range(shards)]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (ids, tokens) in enumerate(batches_of(batches, 1)):
            batch = (task << 32) | number
            distinct, code = _coded(tokens)
            key = np.sort(_pair_keys(distinct, code))
            null = np.array([d is None for d in ids], np.uint8)
            ids = np.array([d or 0 for d in ids], np.int64)
            end = np.searchsorted(distinct, [END])
            order = np.argsort(-np.bincount(code), kind="stable")  # small numbers for frequent words
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            head = pack(batch=np.array([batch]), ids=ids, null=null, n=small(tokens.counts), rank=small(rank[code]), order=small(order), end=end)
            home = batch % shards
            out = [(home, (batch // shards) % parts[home], _HEADER, head)]
            for shard, _, _, x in _pairs_by_shard(distinct, key[_starts(key)], shards):
                out.append((shard, batch % parts[shard], _REQUEST, pack(batch=np.array([batch]), **x)))
            yield _packed(out)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, model = None, None
        for batch in batches:
            out = []
            for shard, part, kind, block in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if current != (shard, part):
                    current, model = (shard, part), None
                if kind == _MODEL:
                    model = ShardModel(shard, block, shared.value).predictive()
                    continue
                x = unpack(block)
                if kind == _REQUEST:
                    if model is None:  # a shard without a training word
                        model = ShardModel(shard, _empty_model(), shared.value).predictive()
                    block = pack(**model.look_up(x["words_sorted"], x["pairs"].astype(np.int64), x["known_sorted"], x["contexts_sorted"]))
                out.append((int(x["batch"][0]), shard if kind == _REQUEST else -1, block))
            yield _rows(out, ["batch", "shard", "block"], [pa.int64(), pa.int32(), pa.binary()])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SCORED.split(", ")]
        for _, rows in _groups(batches):
            if rows[0][0] != -1:
                raise AssertionError("an answer without its batch")
            head, answers = unpack(rows[0][1]), [unpack(block) for _, block in rows[1:]]  # words and pairs ascend with the shards
            x = {k: np.concatenate([a[k] for a in answers]) for k in answers[0]}
            code, n = head["order"].astype(np.int64)[head["rank"]], head["n"].astype(np.int64)
            tokens = code * CONTEXTS + np.concatenate([head["end"], code[:-1]])
            pairs = np.sort(tokens)
            pairs = pairs[_starts(pairs)]
            word, context = pairs // CONTEXTS, pairs % CONTEXTS
            pair = np.searchsorted(pairs, tokens).astype(np.int32)
            del answers, code, tokens, pairs
            by_word = [x[f"word{k}"] for k in range(1 + 2 * SAMPLES)]
            by_context = [x[f"context{k}"] for k in range(1 + SAMPLES)]
            of_pairs = judged(shared.value, x["counts"], x["seated"], by_word, word, by_context, context)
            doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
            total, base, known = (np.bincount(doc, v[pair], minlength=len(n)) for v in of_pairs)
            known = known.astype(np.int64)
            ids = pa.array(head["ids"], pa.int64(), mask=head["null"].astype(bool))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(known), pa.array(base), pa.array(total)], names=names)

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    copies = F.transform(F.array(*map(F.lit, parts)), lambda x: x)
    model_rows = models.select("shard", F.explode(F.sequence(F.lit(0), F.get(copies, F.col("shard")) - 1)).alias("part"), F.lit(_MODEL).alias("kind"), F.col("model").alias("block"))
    asked = source.mapInArrow(ask, _PACKED).unionByName(model_rows)
    answers = asked.repartition("shard", "part").sortWithinPartitions("shard", "part", "kind").mapInArrow(answer, _ANSWER)
    met = answers.repartition("batch").sortWithinPartitions("batch", "shard")
    return met.mapInArrow(collect, _SCORED)


def _empty_model() -> bytes:
    names = ["words_sorted", "pairs", "known_sorted", "contexts_sorted", "counts", "seated", "owned_sorted", "customers"]
    names += [f"{k}{s}" for s in range(SAMPLES) for k in ("customers1_", "tables1_", "owned_tables")]
    return pack(**{k: np.empty(0, np.uint64) for k in names})
