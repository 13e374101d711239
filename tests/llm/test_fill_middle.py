"""Fill-in-middle: the class matrix and the cuts against plain Python, forms, markers and odd texts."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import fill_middle
from granary.llm.class_matrix import ClassMatrix
from granary.llm.queries import QUERIES
from tests.llm.helpers import SMALL, docs, odd_rows

UNITS = {"word": re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"), "line": re.compile(r"[^\n]*\n|[^\n]+")}


def plainly(doc_id, text, unit="word"):
    """(units, form, prefix, middle, output) of one document, without any index."""
    text = text or ""
    tokens = UNITS[unit].findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd():
    rnd = random.Random(11)
    parts = [" ", "  ", "\n", "\t\r\n", "a", "é", "漢字", "🙂", "\x00", "\x1c", "\x85", " ", "<", "<P", "<S>", "P>", "word"]
    rows = odd_rows() + [(k, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))) for k in range(1000, 1400)]
    return rows + [(1500, " \n "), (1501, "x"), (1502, "\n"), (1503, "a <M> b"), (1504, " ".join(["long"] * 400_000))]


def test_class_matrix_against_counting():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        row = rnd.integers(0, 6, n).astype(np.uint8)
        matrix, at = ClassMatrix(row, 3), np.arange(n + 1)
        for kind in range(8):
            assert matrix.rank(kind, at).tolist() == [int((row[:i] == kind).sum()) for i in at]
        both = np.isin(row, (1, 4))
        want = rnd.integers(0, n + 2, 20)
        low, high = np.zeros(20, np.int64), np.full(20, n)
        found = matrix.bisect((1, 4), want, low, high).tolist()
        assert found == [next((i for i in range(n) if both[:i].sum() >= w), n) for w in want]


@pytest.mark.parametrize("unit", ["word", "line"])
def test_cuts_forms_and_restored_text(spark, unit):
    rows = odd()
    frame = docs(spark, rows)
    done = fill_middle.transform(frame, unit=unit).withColumn("again", fill_middle.restored("output", "form"))
    found = sorted((tuple(r) for r in done.collect()), key=repr)
    want = sorted(((r[0], *plainly(r[0], r[1], unit), r[1] or "") for r in rows), key=repr)
    assert found == want
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_other_markers_and_shares(spark):
    markers = ("[pre]", "{suf}", "(mid)")
    frame = docs(spark, odd_rows())
    done = fill_middle.transform(frame, seed="7", fim_percent=100, spm_percent=0, markers=markers)
    done = done.withColumn("again", fill_middle.restored("output", "form", markers)).join(frame.select("doc_id", F.coalesce("text", F.lit("")).alias("t")), "doc_id")
    assert done.filter((F.col("form") == "psm") & (F.col("again") != F.col("t"))).filter(F.col("doc_id") != 7).isEmpty()
    assert {r["form"] for r in done.select("form").distinct().collect()} == {"plain", "psm"}
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "<P>x", "<M>"), ("<<", "<S>", "<M>"), ("é", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.transform(frame, markers=bad)


def test_empty_table_and_query(spark):
    assert fill_middle.transform(docs(spark, [])).count() == 0
    rows = QUERIES["op12_fill_middle"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n, form, prefix, middle, output = plainly(r["doc_id"], texts[r["doc_id"]])
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (output, texts[r["doc_id"]] or "")]
        assert tuple(r) == (r["doc_id"], n, form, prefix, middle, *digest)
