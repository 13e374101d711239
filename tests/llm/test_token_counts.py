"""Token counts by transducers against the tokenizers library, the lexer against plain runs, and odd texts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from granary.llm import token_counts, transducer
from granary.llm.queries import QUERIES
from tests.llm.helpers import SF, docs, odd_rows

PARTS = ["'s", "'t", "'re", "'r", "'", "''", " ", "  ", "\n", "\t", " ", "　", "a", "Z", "é", "漢", "1", "23", "½", "²", "!", "?!", "<|endoftext|>"]
PARTS += ["<|", "|>", "the", " hello", "\x00", "\x1c", "\x85", "ǅ", "İ", "🙂", "́", "'ll", "'LL", "'m", "aaaa", "aaaaaaa", "====", "    ", "\r\n", "​"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def by_library(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def by_machine(texts):
    encoded = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in encoded])]).astype(np.int64)
    return token_counts.counter().count_texts(b"".join(encoded), bounds).tolist()


def test_odd_texts(library):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(5000)]
    texts += ["".join(rnd.choice("aA=- ") for _ in range(rnd.randint(1, 90))) for _ in range(2000)]
    texts += ["".join(rnd.choice("abcdefgstherin") for _ in range(rnd.randint(1, 300))) for _ in range(500)]
    assert by_machine(texts) == by_library(library, texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=8))
def test_any_texts(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert by_machine(texts) == by_library(library, texts)


def test_every_token_is_one(library):
    """Each merge's token is its own encoding, which the machine relies on."""
    machine = token_counts.counter().machine
    for token in range(256, len(machine.parts)):
        assert machine.may_follow(*machine.parts[token]) is False
    spelled = [bytes([b]) for b in range(256)]
    for left, right in machine.parts[256:]:
        spelled.append(spelled[left] + spelled[right])
    sizes = np.array([len(s) for s in spelled])
    counts = machine.count(np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert (counts == 1).all()


def test_machine_starts_anew_without_other_results(library, monkeypatch):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcdefghij ") for _ in range(400)) for _ in range(50)]
    texts += ["".join(rnd.choice("abcdefghij") for _ in range(5000))]
    monkeypatch.setattr(transducer, "MAX_TRANSITIONS", 100)
    monkeypatch.setattr(transducer, "_STRIDE", 64)
    assert [by_machine([t])[0] for t in texts] == by_library(library, texts)


def test_lexer_scan_is_the_plain_run():
    lexer, rnd = token_counts._lexer(), np.random.default_rng(4)
    for n in (1, 63, 64, 65, 1000, 10_000):
        symbols = rnd.integers(0, 18, n).astype(np.uint8)
        state, want = lexer.start, []
        for s in symbols:
            want.append(bool(lexer.begins[s, state]))
            state = lexer.after[s, state]
        assert lexer.run(symbols).tolist() == want


def test_long_texts_in_parts(library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 100)
    rnd = random.Random(5)
    for text in ("".join(rnd.choice([*PARTS, " word", " it's"]) for _ in range(3000)), "x" * 2000, "it's a 'very' long one, " * 200):
        assert token_counts.counter().count_long(text.encode()) == by_library(library, [text])[0]


def test_rows(spark, library):
    rows = odd_rows()
    found = sorted((tuple(r) for r in token_counts.count(docs(spark, rows)).collect()), key=repr)
    counts = by_library(library, [r[1] or "" for r in rows])
    assert found == sorted(((r[0], len((r[1] or "").encode()), n) for r, n in zip(rows, counts, strict=True)), key=repr)
    assert token_counts.count(docs(spark, [])).count() == 0


def test_query(spark, library):
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op13_token_counts"](spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    counts = by_library(library, list(texts.values()))
    assert found == {d: (d, len(t.encode()), n, n > 1024) for (d, t), n in zip(texts.items(), counts, strict=True)}


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.TokenCounter("word_bpe_49k.json")
