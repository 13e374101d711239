"""Small tables that hold the awkward cases: nulls, empty and long texts, repeated rows, clashing extra columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, items string"


def docs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang]); the other columns hold values that an operator must not take for its own."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), -7, None, "x") for r in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows(seed: int = 5) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary = [a + b for a in "abcdeéß" for b in ("n", "rst", "ou", "É", "漢")]
    rows: list[tuple] = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (None, "a null id, of some words."), (5, "\u0000x <|endoftext|> İ ǅ é ½ 🙂 don't I'LL")]
    for i in range(6, 40):
        rows.append((i, " ".join(rnd.choice(vocabulary) + rnd.choice(["", "", ",", ".", "***"]) for _ in range(rnd.randint(1, 120)))))
    rows.append((7, rows[12][1]))  # a repeated id with another text
    rows += [rows[10], rows[10]]  # repeated rows
    rows.append((99, " ".join(rnd.choice(vocabulary) for _ in range(30_000))))  # a very long text
    return rows
