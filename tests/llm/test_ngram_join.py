"""The n-gram join against all pairs of full n-gram sets."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from granary.llm import ngram_join as nj
from granary.llm import queries
from tests.llm.helpers import SF, docs, odd_rows
from tests.llm.test_decontamination import words


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def brute(rows, size=5, threshold=0.8):
    """(links, smallest id of the group) per row by comparing all pairs that share an n-gram."""
    sets = [shingles(t, size) for _, t in rows]
    by_gram, links, parent = {}, Counter(), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for k in {k for g in s for k in by_gram.get(g, ())}:
            if len(s & sets[k]) >= threshold * len(s | sets[k]) - 1e-9:
                links[i] += 1
                links[k] += 1
                parent[find(i)] = find(k)
        for g in s:
            by_gram.setdefault(g, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d if d is not None else -1), d if d is not None else -1)
    return sorted((d if d is not None else -1, links[i], least[find(i)]) for i, (d, _) in enumerate(rows))


def near_copies():
    rnd = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(400)]
    rows = [r[:2] for r in odd_rows()]
    for base in range(12):
        text = [rnd.choice(vocabulary) for _ in range(rnd.choice([8, 30, 80, 200]))]
        for i in range(rnd.choice([2, 5, 40])):
            copy = list(text)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            rows.append((1000 + 100 * base + i, " ".join(copy).upper() if i % 3 else ", ".join(copy)))
    return rows


@pytest.mark.parametrize("block_shingles", [nj.BLOCK_SHINGLES, 600])
def test_join(spark, block_shingles):
    rows = near_copies()
    out = nj.link(docs(spark, rows).repartition(3), recall=0.9999999, block_shingles=block_shingles).collect()
    least = lambda d: -1 if d is None else d
    assert sorted((least(r.doc_id), r.n_links, least(r.class_id)) for r in out) == brute(rows)


def test_keep_one(spark):
    rows = near_copies()
    kept = nj.keep_one(docs(spark, rows), recall=0.9999999).collect()
    want = {c for _, _, c in brute(rows)}
    assert {-1 if r.doc_id is None else r.doc_id for r in kept} == want
    assert all(r.n_words == -7 and r["items"] == "x" for r in kept)


def test_bands():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = nj.choose_bands(threshold, 0.999)
        assert 1 - (1 - threshold**rows) ** bands >= 0.999 and bands * rows <= nj.MAX_HASHES


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 200)] + [(5, k) for k in range(300, 340)] + [(339, 150), (1, 2), (3, 3)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in nj.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 5 for i in [5, *range(100, 201), *range(300, 340)]}, 1: 1, 2: 1}


def test_empty(spark):
    assert nj.link(docs(spark, [])).count() == 0
    assert nj.link(docs(spark, [(1, None), (2, "")])).filter("n_links = 0 and class_id = doc_id").count() == 2


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in queries.QUERIES["op2_ngram_join"](spark, SF).collect())
    want = brute(rows)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.995 * len(want)  # the target recall is 0.999 a link
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
