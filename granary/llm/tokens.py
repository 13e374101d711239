"""Tokenizer encoding of Arrow text columns with a per-process word cache.

The tokenizers used here drop white space and never join pieces across it, so the ids of a text are the ids of its
chunks between ASCII white space, one after the other (``tests/llm`` checks this against whole-text encoding). Each
distinct chunk is encoded once per worker process and its ids are gathered with numpy. The cache is emptied when it
reaches ``CACHE_WORDS`` entries, which bounds memory and changes no result.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from granary.llm.textnp import slices

CACHE_WORDS = 500_000
SLICE_BYTES = 1 << 20
JOINED = 500  # plain words that the model takes at a time
DEFAULT_TOKENIZER = "word_bpe_49k.json"

# Letters that normalising and splitting leave as they are: a run of them is one piece.
_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(f"[{_LETTERS}]+")

_encoders: dict[str, "ChunkEncoder"] = {}


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Path of a public tokenizer's file on this machine; ``name`` may also be a path of its own."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        # how the pre-tokenizer writes each of the letters that it and the normaliser leave alone
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {ord(c): split(c)[0][0] for c in _LETTERS}
        # the model alone, for many plain words at a time; each word's ids end with one that carries the word-end suffix
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = WhitespaceSplit()
        suffix, size = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab_size()
        if not suffix:
            raise ValueError(f"a tokenizer without word ends: {name}")
        self.ends = np.fromiter(((self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)), bool, size)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.lens = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.used = 0

    def _add(self, chunks: list[str]) -> None:
        """Encode chunks that the cache lacks and append their ids to the pool."""
        plain, other = [], []
        for chunk in chunks:  # a plain chunk is one piece of the pre-tokenizer
            (plain if _PLAIN.fullmatch(chunk) else other).append(chunk)
        chunks = plain + other
        spelled = [c if c.isascii() else c.translate(self.letters) for c in plain]
        joined = [" ".join(spelled[i : i + JOINED]) for i in range(0, len(spelled), JOINED)]
        flat = [np.array(e.ids, np.uint32) for e in self.words.encode_batch_fast(joined, add_special_tokens=False)]
        flat = np.concatenate([np.empty(0, np.uint32), *flat])
        lens = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
        whole = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        lens = np.concatenate([lens, np.fromiter(map(len, whole), np.int64, len(whole))])
        flat = np.concatenate([flat, np.fromiter(itertools.chain.from_iterable(whole), np.uint32)])
        at, n = len(self.index), len(chunks)
        if at + n > len(self.starts):
            grow = max(at + n, 2 * len(self.starts))
            self.starts, self.lens = np.resize(self.starts, grow), np.resize(self.lens, grow)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, max(self.used + len(flat), 2 * len(self.pool)))
        self.starts[at : at + n] = self.used + np.cumsum(lens) - lens
        self.lens[at : at + n] = lens
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.index.update(zip(chunks, range(at, at + n), strict=True))

    @staticmethod
    def _fold(col: pa.Array) -> pa.Array:
        """Fewer distinct chunks with the same ids: fold A-Z and part a word from the punctuation that ends it.

        A run of punctuation between a plain letter and white space is a piece of its own in any case (other letters may
        lower to a mark that joins it). A text that holds
        an opening mark of special tokens is left alone, since those are matched before case folding.
        """
        if pc.any(pc.match_substring(col, "<|")).as_py():
            return col
        return pc.replace_substring_regex(pc.ascii_lower(col), rf"([{_LETTERS}])([,.!?*#%$&|]+)(\s|$)", r"\1 \2\3")

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids uint32, offsets int64 of len(col) + 1) of a string column; null counts as empty."""
        lists = pc.ascii_split_whitespace(self._fold(col.fill_null("").cast(pa.string())))
        flat = lists.flatten().dictionary_encode()
        chunks = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.index) + len(chunks) > CACHE_WORDS:
            self._clear()
        at = list(map(self.index.get, chunks))
        if missing := [c for c, k in zip(chunks, at, strict=True) if k is None]:
            self._add(missing)
            at = list(map(self.index.__getitem__, chunks))
        at = np.array(at, np.int64)
        code = flat.indices.to_numpy(zero_copy_only=False)
        starts, lens = self.starts[at][code], self.lens[at][code]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(starts - (ends - lens), lens) + np.arange(total)]
        bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        return ids, np.concatenate([[0], ends])[bounds]


def encoder(name: str = DEFAULT_TOKENIZER) -> ChunkEncoder:
    if name not in _encoders:
        _encoders[name] = ChunkEncoder(name)
    return _encoders[name]


def encode_documents(
    col: pa.Array, end_id: int, name: str = DEFAULT_TOKENIZER, slice_bytes: int = SLICE_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets) for slices of the column; every document's ids end with ``end_id``.

    Larger slices look up fewer distinct chunks in all and hold more memory; the ids are the same.
    """
    enc = encoder(name)
    for i, j in slices(col, slice_bytes):
        ids, bounds = enc.encode(col.slice(i, j - i))
        yield i, np.insert(ids, bounds[1:], end_id).astype("<u4", copy=False), bounds + np.arange(j - i + 1)
