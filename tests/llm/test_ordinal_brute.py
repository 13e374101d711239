"""The quality classifier against a plain version: features by regular expressions, probabilities one document at a time."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granary.llm import ordinal
from granary.llm.textnp import ALNUM_TABLE, mix64, words_of
from tests.llm.helpers import SMALL, docs, odd_rows

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
SYMBOL = re.compile("[" + re.escape("#*$%&|<>!?@~^_=+/\\{}[]") + "]+")


def hashed(piece, table):
    return int(words_of(pa.array([piece]), table).hashes[0])


def mixed(value):
    return int(mix64(np.array([value], np.uint64))[0])


def plain_features(text):
    words, symbols = (p.findall(text or "") for p in (WORD, SYMBOL))
    found = Counter(hashed(w, ALNUM_TABLE) % ordinal.DIMENSIONS for w in words)
    found.update(mixed(hashed(s, ordinal.SYMBOL_TABLE) + 1) % ordinal.DIMENSIONS for s in symbols)
    if words or symbols:
        lower = {w.translate({c: c + 32 for c in range(65, 91)}) for w in words}
        found[mixed(int(math.log2(len(words) + len(symbols) + 1)) + (1 << 40)) % ordinal.DIMENSIONS] += 1
        found[mixed(int(10 * len(lower) / max(1, len(words))) + (1 << 41)) % ordinal.DIMENSIONS] += 1
    return {k: math.log1p(n) for k, n in found.items()}


def plain_rating(text, model):
    score = sum(model.weights[k] * v for k, v in plain_features(text).items())
    above = [1 / (1 + math.exp(-(score - cut))) for cut in model.cuts]
    return score, sum(above), above[-1]


@pytest.fixture(scope="module")
def fitted(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    ratings = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", grade.alias("grade"))
    return table, ratings, ordinal.fit(table, ratings, n_grades=3)


def test_ratings_of_every_document(spark, fitted):
    table, _, model = fitted
    for frame in (table, docs(spark, odd_rows())):
        texts = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
        want = sorted((d is not None, d or 0, *(round(x, 6) for x in plain_rating(t, model))) for d, t in texts)
        out = ordinal.classify(frame, model).collect()
        found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["score"], r["expected_grade"], r["tail_probability"]) for r in out)
        assert len(found) == len(want)
        for a, b in zip(found, want, strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=2e-4)


def test_the_fit_is_a_minimum_of_the_plain_loss(fitted):
    table, ratings, model = fitted
    lowest = ratings.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    rated = [(plain_features(r["text"]), r["grade"]) for r in table.join(lowest, "doc_id").select("text", "grade").collect()]

    def loss(weights, cuts):
        total = 0.0
        for feature, grade in rated:
            score = sum(weights[k] * v for k, v in feature.items())
            ends = [0.0, *(1 / (1 + math.exp(-(c - score))) for c in cuts), 1.0]
            total -= math.log(max(1e-12, ends[grade + 1] - ends[grade]))
        return total / len(rated) + 0.5 * ordinal.L2 * float(weights @ weights)

    best = loss(model.weights, model.cuts)
    rng = np.random.default_rng(1)
    used = np.flatnonzero(model.weights)
    for _ in range(8):
        moved = model.weights.copy()
        moved[used] += rng.normal(0, 0.02, len(used))
        assert loss(moved, model.cuts) > best - 1e-3
    for step in ((0.3, 0.3), (-0.3, -0.3), (0, 0.3), (-0.3, 0)):
        assert loss(model.weights, model.cuts + np.array(step)) > best - 1e-3
    assert best < loss(np.zeros_like(model.weights), model.cuts)
