"""The pipeline against its stages in plain Python."""

from __future__ import annotations

import re
import sys

import corpus_pipeline
from granary.llm import quality_rules, secrets
from tests.llm.helpers import SMALL, docs, odd_rows
from tests.llm.test_decontamination import WORD, words
from tests.llm.test_ngram_join import brute as brute_join
from tests.llm.test_rules import base, scores, spans
from tests.llm.test_tokens_out import check_pieces


def clean(text, items, window=10):
    """The text without hit words, or None if more than half of its words are hit."""
    have, hit = words(text), [False] * len(words(text))
    for t in items:
        w = words(t)
        n = min(window, len(w))
        parts = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(have) - n + 1):
            if tuple(have[i : i + n]) in parts:
                hit[i : i + n] = [True] * n
    if sum(hit) > 0.5 * len(have):
        return None
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    at = [m.span() for m in WORD.finditer(lowered)]
    out, end, i = "", 0, 0
    while i < len(hit):
        if not hit[i]:
            i += 1
            continue
        first = i
        while i < len(hit) and hit[i]:
            i += 1
        out += text[end : at[first][0]]
        end = at[i - 1][1]
    return out + text[end:]


def mask(text):
    out, end = "", 0
    for start, _, kind, stop in spans(text):
        if start >= end:
            out += text[end:start] + f"[{kind}]"
            end = stop
        else:
            end = max(end, stop)
    return out + text[end:]


def brute(rows, labels, items):
    kept = [r for r, s in zip(rows, scores(rows, labels), strict=True) if not base(r[1])[-1] and s >= quality_rules.THRESHOLD]
    ids = {c for _, _, c in brute_join(kept)}
    kept = [r for r in kept if r[0] in ids]
    kept = [(d, t) for d, t in ((d, clean(t, items)) for d, t in kept) if t is not None]
    return [(d, mask(t)) for d, t in kept]


def test_run(spark):
    read = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet").collect()
    rows = [(r.doc_id, r.text) for r in read("documents")]
    want = brute(rows, [tuple(r) for r in read("labels")], [r.text for r in read("benchmark")])
    assert 0 < len(want) < len(rows)
    check_pieces(want, corpus_pipeline.run(spark, SMALL).collect())


def test_stages_hand_on_documents(spark):
    table = docs(spark, odd_rows())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, SMALL).columns == table.columns, name
        assert stage(spark, docs(spark, []), SMALL).count() == 0, name
    for _, stage in corpus_pipeline.STAGES[2:4]:  # these drop no clean document
        assert stage(spark, table, SMALL).count() == table.count()


def test_registered():
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and "granary.llm" in sys.modules
    assert {n.split("_")[0] for n in __spark_entry__.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
    assert secrets.RULES[:3] == secrets.BASE_RULES
