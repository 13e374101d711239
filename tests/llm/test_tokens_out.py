"""Encoding, wavelet-matrix files and packing against direct encoding."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from granary.llm import packing, queries, token_files
from granary.llm.tokens import encoder
from granary.llm.wavelet import Shard, WaveletMatrix
from tests.llm.helpers import SF, docs, odd_rows

WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def direct(text: str | None, end: int) -> list[int]:
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=300, deadline=None)
@example(["İ.", "a\u0301.", "É, é, ß! K."])
@given(st.lists(st.text(st.sampled_from(list("abzABZ019.,*'| \n\t\x1c\x85\xa0éÉİß漢🙂́<>")), max_size=40), max_size=5))
def test_chunk_encoding_equals_whole_encoding(texts):
    ids, bounds = encoder().encode(pa.array([*texts, None], pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [WHOLE.encode(t, add_special_tokens=False).ids for t in texts] + [[]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=3000), st.integers(0, 2**32))
def test_wavelet_matrix(values, seed):
    ids = np.array(values, np.uint32)
    matrix = WaveletMatrix.build(ids)
    assert matrix.decode().tolist() == values
    rnd = random.Random(seed)
    for i in rnd.sample(range(len(values)), min(20, len(values))):
        assert matrix.access(i) == values[i]
        assert matrix.count(values[i], 0, i) == values[:i].count(values[i])
        assert matrix.select(values[i], values[:i].count(values[i])) == i
        assert matrix.occurrences(values[i]) == [k for k, v in enumerate(values) if v == values[i]]
    assert matrix.count(12345678) == 0


def test_token_files(spark):
    rows = odd_rows()
    path = queries.scratch_path(spark, "test-token-files")
    manifest = token_files.write_tokens(docs(spark, rows).repartition(3), path, shard_tokens=2000)
    assert manifest.count() > 3
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_tokens(spark, path).collect())
    order = [r[1] for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    want = sorted((d is not None, d or 0, len(direct(t, 1)), crc(direct(t, 1))) for d, t in [r[:2] for r in rows])
    assert sorted((d is not None, d or 0, n, c) for _, d, n, c in got) == want
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    shard = Shard(open(token_files.shard_paths(spark, path).first()["path"].removeprefix("file:"), "rb").read())
    assert shard.matrix().count(1) >= len(shard.doc_ids)


def check_pieces(rows, pieces, size=4096):
    """Every id lies in one piece; sequences hold pieces without gaps and at most ``size`` ids."""
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(direct(text, 2))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc_id, held in texts.items():
        want = sorted((s, min(size, len(ids) - s), crc(ids[s : s + size]), len(ids)) for ids in held for s in range(0, len(ids), size))
        assert sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc_id]) == want
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return sum(p.length for p in pieces), len(by_sequence)


@pytest.mark.parametrize("open_windows", [1, 3, 64])
def test_packing(spark, open_windows):
    rows = odd_rows()
    pieces = packing.pack(docs(spark, rows).repartition(4), open_windows=open_windows, merge_partitions=2).collect()
    check_pieces([r[:2] for r in rows], pieces)


def test_packing_table_has_little_padding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    tokens, sequences = check_pieces(rows, queries.QUERIES["op10_pack"](spark, SF).collect())
    assert tokens > 0.99 * 4096 * (sequences - 1)


def test_empty_tables(spark):
    empty = docs(spark, [])
    assert packing.pack(empty).count() == 0
    path = queries.scratch_path(spark, "test-token-files")
    token_files.write_tokens(empty, path)
    assert token_files.read_tokens(spark, path).count() == 0


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op5_wavelet_tokens"](spark, SF).collect()}
    at = 0
    for r in rows:
        ids = direct(r.text, 1)
        assert got[r.doc_id] == (at, len(ids), crc(ids))
        at += len(ids)
