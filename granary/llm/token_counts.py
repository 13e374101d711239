"""Token counts of documents under a byte-level byte-pair tokenizer, by compiled transducers.

Two machines (``transducer``) in a row: a lexer cuts the characters of a slice of documents into the tokenizer's pieces,
all chunks of the slice at once, and a token machine, compiled from the tokenizer's merges, counts the tokens of each
distinct piece of the slice once. What the pieces of a document emit adds up to its count; no token ids are made.

The lexer's symbols are character classes with what the split rule looks ahead for: whether white space comes just before
another character, and whether an apostrophe opens a contraction. Classes of characters outside ASCII are asked of the
tokenizer's own splitter when they are first met, so they follow its tables. Strings of added tokens count as one token,
as they do in the tokenizer by default, and cut the text around them.

A document longer than a slice is counted in parts, cut before a space between two visible ASCII characters, where a piece
always starts, whatever comes before.

Defined cases: a null or empty text has 0 bytes and tokens; a null id stays null; repeated rows are counted each; an empty
table has an empty result; other columns are ignored. A tokenizer of another kind is refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.textnp import slices, text_buffer
from granary.llm.tokens import tokenizer_path
from granary.llm.transducer import Lexer, TokenMachine

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
SLICE_BYTES = 2 << 20

OUTPUT = "doc_id long, n_bytes long, n_tokens long"

# Symbols: letters, numbers, others; an apostrophe with a contraction of one or of two letters after it; white space just
# before another character (a space, which joins it, or another one) and elsewhere; then the same at the start of a text,
# a special string's first character and its others, and the symbol that changes nothing.
LETTER, NUMBER, OTHER, SHORT, LONG, JOINING, LONELY, BLANK = range(8)
_FIRST, _SPECIAL, _SPECIAL_ON, _NOTHING = 8, 16, 17, 18
# States: a piece has ended; letters; numbers; others; a space that joins; letters of a contraction to come; white space
_END, _LETTERS, _NUMBERS, _OTHERS, _SPACE, _ONE_MORE, _TWO_MORE, _BLANKS = range(8)
_SPACE_KIND, _WHITE_KIND, _UNKNOWN = 3, 4, 255

_counters: dict[str, "TokenCounter"] = {}
_SAFE = re.compile(rb"[!-~](?= [!-~])")


def _lexer() -> Lexer:
    after = np.zeros((_NOTHING + 1, 8), np.uint8)
    begins = np.zeros(after.shape, bool)
    opened = {LETTER: _LETTERS, NUMBER: _NUMBERS, OTHER: _OTHERS, SHORT: _ONE_MORE, LONG: _TWO_MORE, JOINING: _SPACE, LONELY: _END, BLANK: _BLANKS}
    for symbol, state in opened.items():
        for at in (symbol, symbol + _FIRST):
            after[at], begins[at] = state, True
    goes_on = {
        _LETTERS: {LETTER: _LETTERS},
        _NUMBERS: {NUMBER: _NUMBERS},
        _OTHERS: {OTHER: _OTHERS, SHORT: _OTHERS, LONG: _OTHERS},
        _SPACE: {LETTER: _LETTERS, NUMBER: _NUMBERS, OTHER: _OTHERS, SHORT: _OTHERS, LONG: _OTHERS},
        _ONE_MORE: {LETTER: _END},
        _TWO_MORE: {LETTER: _ONE_MORE},
        _BLANKS: {BLANK: _BLANKS},
    }
    for state, moves in goes_on.items():
        for symbol, target in moves.items():
            after[symbol, state], begins[symbol, state] = target, False
    after[_SPECIAL], begins[_SPECIAL] = _END, True
    after[_SPECIAL_ON] = _END
    after[_NOTHING] = np.arange(8)
    return Lexer(after, begins, _END)


def _bytes_of(vocabulary: dict[str, int]) -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible bytes for themselves, the others in order
    from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(visible)]
    table = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(other)}
    if not set(table) <= set(vocabulary):
        raise ValueError("not a byte-level vocabulary")
    return table


class TokenCounter:
    def __init__(self, name: str):
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model, added = spec["pre_tokenizer"], spec["model"], spec["added_tokens"]
        plain = split and split["type"] == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True)
        odd = model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges")
        odd = odd or spec["normalizer"] or spec["truncation"] or spec["padding"] or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip"))
        if not plain or odd or model["type"] != "BPE":
            raise ValueError(f"not a plain byte-level byte-pair tokenizer: {name}")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        table = _bytes_of(model["vocab"])
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.machine = TokenMachine([tuple(bytes(table[c] for c in side) for side in m) for m in merges])
        self.lexer = _lexer()
        strings = sorted((t["content"].encode() for t in added), key=lambda s: (-len(s), s))
        self.special = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        self.special_strings = set(strings)
        self.kinds = np.full(0x110000, _UNKNOWN, np.uint8)
        self.kinds[ord(" ")] = _SPACE_KIND

    def _kinds(self, chars: np.ndarray) -> np.ndarray:
        kinds = self.kinds[chars]
        unknown = np.unique(chars[kinds == _UNKNOWN])
        for c in unknown.tolist():
            joined = [kind for kind, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(self.split(mate + chr(c))) == 1]
            self.kinds[c] = joined[0] if joined else _WHITE_KIND
        return self.kinds[chars] if len(unknown) else kinds

    def _pieces(self, data: bytes, bounds: np.ndarray) -> np.ndarray:
        """Where the pieces of texts start, which lie one after the other in ``data``."""
        chars = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), "<u4")
        buf = np.frombuffer(data, np.uint8)
        at = np.flatnonzero((buf & 0xC0) != 0x80)
        n = len(chars)
        cuts, special = bounds, []
        if self.special is not None and self.special.search(data):
            ends = bounds.tolist()
            special = [(a + m.start(), a + m.end()) for a, b in zip(ends, ends[1:], strict=False) for m in self.special.finditer(data[a:b])]
            cuts = np.concatenate([bounds, np.array(special, np.int64).reshape(-1)])
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(at, cuts)] = True
        first[n] = True
        kinds = self._kinds(chars)
        white = kinds >= _SPACE_KIND
        before_visible = ~first[1:] & np.append(~white[1:], False)
        symbols = np.where(white, np.where(before_visible, np.where(kinds == _SPACE_KIND, JOINING, LONELY), BLANK), kinds).astype(np.uint8)
        marks = np.flatnonzero(chars == ord("'"))
        if len(marks):
            padded = np.append(chars, [0, 0])
            one, two = padded[marks + 1], padded[marks + 2]
            near = ~first[marks + 1]
            far = near & ~np.append(first, True)[marks + 2]
            symbols[marks[near & np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
            pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
            symbols[marks[far & np.any([(one == a) & (two == b) for a, b in pairs], axis=0)]] = LONG
        symbols[first[:-1]] += _FIRST
        for a, b in special:
            low, high = np.searchsorted(at, [a, b])
            symbols[low:high] = _SPECIAL_ON
            symbols[low] = _SPECIAL
        return at[self.lexer.run(symbols)]

    def count_texts(self, data: bytes, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each text; the texts lie between ``bounds`` in ``data``."""
        if not data:
            return np.zeros(len(bounds) - 1, np.int64)
        starts = self._pieces(data, bounds)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        edges = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
        tokens = self.machine.count(np.frombuffer(distinct.buffers()[2], np.uint8), edges[:-1], np.diff(edges))
        if self.special is not None and self.special.search(data):
            tokens[[p in self.special_strings for p in distinct.to_pylist()]] = 1
        sums = np.concatenate([[0], np.cumsum(tokens[coded.indices.to_numpy(zero_copy_only=False)])])
        return np.diff(sums[np.searchsorted(starts, bounds)])

    def count_long(self, data: bytes) -> int:
        """Tokens of one long text, part by part."""
        total = at = 0
        while at < len(data):
            safe = _SAFE.search(data, at + SLICE_BYTES) if len(data) - at > 2 * SLICE_BYTES and not self._holds_space() else None
            end = safe.end() if safe else len(data)
            total += int(self.count_texts(data[at:end], np.array([0, end - at]))[0])
            at = end
        return total

    def _holds_space(self) -> bool:
        return any(b" " in s for s in self.special_strings)


def counter(name: str = TOKENIZER) -> TokenCounter:
    if name not in _counters:
        _counters[name] = TokenCounter(name)
    return _counters[name]


def count(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per document (``doc_id``, ``text``): its bytes in UTF-8 and its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(tokenizer)
        for batch in batches:
            sizes, counts = [], []
            for i, j in slices(batch.column(1), SLICE_BYTES):
                buf, bounds = text_buffer(batch.column(1).slice(i, j - i))
                data = buf.tobytes()
                sizes.append(np.diff(bounds))
                counts.append(np.array([tokens.count_long(data)]) if j == i + 1 else tokens.count_texts(data, bounds))
            columns = [np.concatenate([np.empty(0, np.int64), *x]) for x in (sizes, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_bytes", "n_tokens"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, OUTPUT)
