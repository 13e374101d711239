"""Decontamination against a comparison of all windows."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest

from granary.llm import decontamination as dc
from granary.llm import queries
from tests.llm.helpers import SF, docs, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    """(words, hit mask, items) by comparing every window."""
    have, hit, found = words(text), set(), set()
    at = {}
    for n in {min(window, len(words(t))) for _, t in items} - {0}:
        for i in range(len(have) - n + 1):
            at.setdefault(tuple(have[i : i + n]), []).append(i)
    for name, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = tuple(w[i : i + window])
            for p in at.get(part, []):
                hit |= set(range(p, p + len(part)))
                found.add(str(name))
    return len(have), len(hit), sorted(found)


def fixture():
    rnd = random.Random(11)
    vocabulary = ["the", "of", "Ab", "c1", "élan", "ÉL", "x", "y"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 2, 5, 9, 10, 11, 14, 30])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "?!"), (103, items[5][1]), (5, items[7][1])]
    rows = odd_rows()
    for i in range(200, 320):
        text = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            source = words(rnd.choice(items)[1])
            a = rnd.randint(0, max(0, len(source) - 1))
            at = rnd.randint(0, len(text))
            text[at:at] = source[a : a + rnd.randint(1, 20)]
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(text)))
    return rows, items


@pytest.mark.parametrize("block_words", [1_000_000, 150])
def test_windows(spark, block_words):
    rows, items = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.match_spans(docs(spark, rows), benchmark, block_words=block_words).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, sorted(r["items"])) for r in found)
    assert got == sorted((d or -1, *brute(t, items)) for d, t in [r[:2] for r in rows])
    assert any(r.n_hit for r in found)


@pytest.mark.parametrize("block_words", [1_000_000, 150])
def test_spans_leave_the_text(spark, block_words):
    item = " ".join(f"w{i}" for i in range(20))
    other = " ".join(f"v{i}" for i in range(300))
    rows = [(1, f"Keep this. {item.upper()}, and that {other}"), (2, item), (3, "clean text"), (4, None), (5, "")]
    benchmark = spark.createDataFrame([(1, item), (2, other[:30])], "item_id long, text string")
    source = docs(spark, rows)
    got = {r.doc_id: r for r in dc.decontaminate(source, benchmark, window=10, block_words=block_words).collect()}
    assert set(got) == {1, 3, 4, 5}
    assert "w3" not in got[1].text.lower() and got[1].text.startswith("Keep this. , and that")
    assert got[3].text == "clean text" and got[4].text is None and got[5].text == ""
    assert got[1].lang == "en" and got[1].n_words == -7


def test_longest_match():
    block = dc.ItemBlock(["a", "b"], ["p q r s t u", "q r s x"], 3)
    (row,) = dc._scan(block, pa.array(["q r s t z p q r x r s x"]), 1, False)
    assert row[0] == 12 and row[2] == 4
    assert [(s["first"], s["end"]) for s in row[3]] == [(0, 4), (5, 8), (9, 12)]


def test_blocks_change_nothing(spark):
    rows, items = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    # equal rows behind a shuffle, whose partitions may be put together differently in each of two scans
    source = docs(spark, rows + rows[:40]).repartition(13, "text")
    assert len(dc.item_blocks(benchmark, 100)) > 2
    for min_match in (1, 12):
        one, many = ([r.asDict(recursive=True) for r in dc.match_spans(source, benchmark, 10, min_match, n, True).collect()] for n in (10**6, 100))
        for r in one + many:
            del r["row_id"]
        assert sorted(map(repr, one)) == sorted(map(repr, many))
        assert any(r["n_hit"] and not r["spans"] for r in one) == (min_match > 10)
        one, many = (dc.decontaminate(source, benchmark, 10, min_match, 0.4, n).collect() for n in (10**6, 100))
        assert sorted(map(repr, one)) == sorted(map(repr, many))


def test_blocks_hold_so_many_words(spark):
    items = [(i, f"Ab, c1 (élan) {i}") for i in range(50)] + [(50, None), (51, "?!")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(dc.item_blocks(benchmark, 200)) == 1
    assert len(dc.item_blocks(benchmark, 199)) == 2


def test_empty(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert dc.match_spans(docs(spark, odd_rows()), items).filter("n_hit > 0").count() == 0
    assert dc.match_spans(docs(spark, []), items).count() == 0


def test_whole_table(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op3_decontaminate"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        n, hit, found = brute(r.text, items)
        g = got[r.doc_id]
        assert (g.n_words, g.n_hit, g.n_items, g.contaminated) == (n, hit, len(found), hit > 0)
        assert g.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
