"""Quality classifier: ordinal cumulative-link regression on hashed text.

A document's features are its distinct lower-cased words and symbol runs, hashed to ``DIMENSIONS`` weights that all
grades share; a feature's value is log(1 + count). With score s = w.x and ordered thresholds t_1 < ... < t_(K-1),
P(grade > j) = sigmoid(s - t_(j+1)); the expected grade is the sum of these over j, and the tail probability is the one
of the highest grade, which selects a document from ``SELECT`` on.

Fitting takes at most ``SAMPLE_ROWS`` rated documents (the first in order of a hash of their ids), whose features are
written once as Parquet blobs in the shared checkpoint folder; every step of L-BFGS is one Spark job that sums the
loss and its gradient over the blobs. The driver holds the weights and a few of their differences (``DIMENSIONS``
numbers each), nothing that grows with the documents. Scoring is one map-only pass over all documents.

Defined cases: null, empty and wordless texts have score 0 (the thresholds alone decide); rows without a rating, or
rated twice differently (the lowest counts), are handled before fitting; without rated rows the weights are 0 and the
thresholds even; repeated rows are scored each on their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.textnp import ALNUM_TABLE, Words, mix64, slices, words_of
from granary.session import scratch_path

DIMENSIONS = 1 << 17
SAMPLE_ROWS = 20_000
SELECT = 0.5
L2 = 2e-4
STEPS = 40
TASKS = 12  # of a step's job
MEMORY = 8  # differences that L-BFGS keeps

# Everything but symbols separates, so the words of this table are runs of symbols. Plain punctuation is no symbol.
_SYMBOLS = "#*$%&|<>!?@~^_=+/\\{}[]"
SYMBOL_TABLE = np.zeros(256, np.uint8)
SYMBOL_TABLE[[ord(c) for c in _SYMBOLS]] = [ord(c) for c in _SYMBOLS]


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, indices, values) of the documents of a slice, indices ascending within a document."""
    both: list[Words] = [words_of(col, t) for t in (ALNUM_TABLE, SYMBOL_TABLE)]
    every = np.arange(len(col))
    total = sum(w.counts() for w in both)
    distinct = np.bincount(_distinct(both[0].doc, both[0].hashes)[0], minlength=len(col))
    # two features of a document's shape: its length, and its share of distinct words, in steps
    length = np.log2(total + 1).astype(np.uint64)
    variety = (10 * distinct / np.maximum(1, both[0].counts())).astype(np.uint64)
    shape = [mix64(length + np.uint64(1 << 40)), mix64(variety + np.uint64(1 << 41))]
    doc = np.concatenate([*(w.doc for w in both), every[total > 0], every[total > 0]])
    hashes = np.concatenate([both[0].hashes, mix64(both[1].hashes + np.uint64(1)), *(x[total > 0] for x in shape)])
    doc, index, counts = _distinct(doc, hashes % np.uint64(DIMENSIONS))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(col)))])
    return offsets.astype(np.int64), index.astype(np.int32), np.log1p(counts).astype(np.float32)


def _distinct(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, value, count) of the distinct values of each document, by their low 32 bits."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(32)) | (values & np.uint64(0xFFFFFFFF)))
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(key)))
    return (key[at] >> np.uint64(32)).astype(np.int64), key[at] & np.uint64(0xFFFFFFFF), counts


def _scores(offsets: np.ndarray, indices: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[indices] * values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds of free parameters: the first one, then logarithms of the gaps."""
    return np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))


def loss_and_gradient(scores: np.ndarray, grades: np.ndarray, free: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of -log P(grade), its derivative by each score, and by the thresholds' free parameters."""
    cuts = np.concatenate([[-np.inf], thresholds(free), [np.inf]])
    upper = _sigmoid(cuts[grades + 1] - scores)  # P(y <= grade)
    lower = _sigmoid(cuts[grades] - scores)  # P(y < grade)
    p = np.maximum(upper - lower, 1e-12)
    d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
    by_score = d_upper - d_lower
    by_cut = np.zeros(len(free))
    for j in range(len(free)):
        by_cut[j] = d_lower[grades == j + 1].sum() - d_upper[grades == j].sum()
    by_free = np.cumsum(by_cut[::-1])[::-1].copy()  # a free parameter moves its own and all later thresholds
    by_free[1:] *= np.exp(free[1:])
    return float(-np.log(p).sum()), by_score, by_free


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray

    def rate(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, expected grade, tail probability) of the documents of a slice."""
        score = _scores(*features(col), self.weights)
        above = _sigmoid(score[:, None] - self.cuts[None, :])
        return score, above.sum(axis=1), above[:, -1]


def _feature_blobs(rated: DataFrame) -> DataFrame:
    """Rows of up to a slice of documents: their grades and features as binary columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(0)):
                offsets, indices, values = features(batch.column(0).slice(i, j - i))
                grades = np.asarray(batch.column(1).slice(i, j - i)).astype(np.int32)
                parts = [offsets, indices, values, grades]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["offsets", "indices", "val", "grades"])

    return rated.mapInArrow(run, "offsets binary, indices binary, val binary, grades binary")


def sample(docs: DataFrame, ratings: DataFrame, rows: int) -> DataFrame:
    """``text`` and ``grade`` of at most ``rows`` rated documents."""
    lowest = ratings.filter("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = lowest.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = chosen.select(F.col("doc_id").alias("rated_id"), "grade")  # at most SAMPLE_ROWS ids
    return docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("rated_id")).select("text", F.col("grade").cast("int").alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, rows: int = SAMPLE_ROWS, steps: int = STEPS, l2: float = L2) -> Model:
    """Weights and thresholds for ``ratings`` (``doc_id``, ``grade`` from 0 to ``n_grades`` - 1)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "ordinal-features")
    _feature_blobs(sample(docs, ratings, rows)).write.parquet(path)
    blobs = spark.read.parquet(path).coalesce(TASKS)  # bounded by the sample
    free = n_grades - 1

    def objective(point: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast(point)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x = shared.value
            loss, n, gradient = 0.0, 0, np.zeros(len(x))
            for batch in batches:
                for o, i, v, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    offsets, indices = np.frombuffer(o, np.int64), np.frombuffer(i, np.int32)
                    values, grades = np.frombuffer(v, np.float32), np.frombuffer(g, np.int32)
                    part, by_score, by_free = loss_and_gradient(_scores(offsets, indices, values, x[:-free]), grades, x[-free:])
                    each = np.repeat(by_score, np.diff(offsets)) * values
                    gradient[:-free] += np.bincount(indices, each, minlength=len(x) - free)
                    gradient[-free:] += by_free
                    loss, n = loss + part, n + len(grades)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([n]), pa.array([gradient.tobytes()], pa.binary())], names=["loss", "n", "g"])

        sums = blobs.mapInArrow(run, "loss double, n long, g binary").collect()  # a gradient per task
        shared.destroy()
        total = max(1, sum(r["n"] for r in sums))
        order = sorted(sums, key=lambda r: (r["n"], r["loss"], bytes(r["g"])))  # the sum must not hang on task order
        gradient = sum((np.frombuffer(r["g"]) for r in order), np.zeros(len(point))) / total
        loss = sum(r["loss"] for r in order) / total
        gradient[:-free] += l2 * point[:-free]
        return loss + 0.5 * l2 * float(point[:-free] @ point[:-free]), gradient

    start = np.zeros(DIMENSIONS + free)
    start[-free] = -(free - 1) / 2
    best = minimise(objective, start, steps) if not blobs.isEmpty() else start
    return Model(best[:-free], thresholds(best[-free:]))


def minimise(objective, point: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with a backtracking line search."""
    value, gradient = objective(point)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        move = -_apply_inverse(gradient, pairs)
        slope = float(gradient @ move)
        if slope > -1e-9:
            break
        size = 1.0 if pairs else min(1.0, 1.0 / np.linalg.norm(gradient))
        while True:
            new = point + size * move
            new_value, new_gradient = objective(new)
            if new_value <= value + 1e-4 * size * slope or size < 1e-6:
                break
            size *= 0.4
        s, y = new - point, new_gradient - gradient
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-MEMORY:]
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        point, value, gradient = new, new_value, new_gradient
        if done:
            break
    return point


def _apply_inverse(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    q, kept = gradient.copy(), []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        q -= a * y
        kept.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(kept), strict=True):
        q += s * (a - (y @ q) / (s @ y))
    return q


def classify(docs: DataFrame, model: Model, select: float = SELECT) -> DataFrame:
    """``doc_id``, ``score``, ``expected_grade``, ``tail_probability`` and ``keep`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices(batch.column(1)):
                score, grade, tail = shared.value.rate(batch.column(1).slice(i, j - i))
                cols = [batch.column(0).slice(i, j - i), *map(pa.array, (score, grade, tail, tail >= select))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "expected_grade", "tail_probability", "keep"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, score double, expected_grade double, tail_probability double, keep boolean")
