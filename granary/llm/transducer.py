"""Deterministic transducers for token counting: a lexer whose chunk state maps are composed by a parallel prefix scan, and
a compiled byte-pair tokenizer whose transitions carry the number of tokens they emit.

``Lexer`` is a table machine. A long sequence of symbols is cut into chunks; the map of a chunk sends every state to the
state after it. Maps compose associatively, so the state before each chunk comes from a scan in which maps are composed
at doubling distances, all chunks at once; then every chunk runs from its own state, all chunks at once.

``TokenMachine`` counts the tokens of byte-pair encoding from left to right. The last token of the encoding of a prefix
is the one token that ends there and may follow the last token of the encoding before it: two tokens may follow each
other when no merge across their border would come before the merges that made them. So a machine state is a set of
places where a token may have begun (the node of the token trie reached since, the last token there, and the tokens
emitted since), and a transition by one byte emits the change in the number of tokens. It may be negative, as a longer
token replaces shorter ones; the sum over a piece is its number of tokens. States are numbered and transitions compiled
when they are first met; at ``MAX_TRANSITIONS`` the machine starts anew, which bounds memory and changes no result.
"""

from __future__ import annotations

import numpy as np

CHUNK = 64
MAX_TRANSITIONS = 600_000  # checked between long pieces and between arrays of pieces
LONG_PIECE = 64
_STRIDE = 1 << 16  # bytes of a long piece between looks at the number of transitions
_SLOT_BITS = 22  # of the hash table of transitions; an array of pieces adds far fewer than are free
_SPREAD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class Lexer:
    """Next state and whether a piece starts, by symbol and state."""

    def __init__(self, after: np.ndarray, begins: np.ndarray, start: int):
        """``after`` and ``begins``: [symbols, states]; the last symbol must leave every state as it is."""
        self.after, self.begins, self.start = after.astype(np.uint8), begins.astype(bool), start

    def chunk_maps(self, chunks: np.ndarray) -> np.ndarray:
        """[chunks, states]: the state that each chunk leads to from each state."""
        states = self.after.shape[1]
        flat, maps = self.after.ravel(), np.tile(np.arange(states, dtype=np.uint8), (len(chunks), 1))
        for k in range(chunks.shape[1]):
            maps = flat[chunks[:, k, None].astype(np.int32) * states + maps]
        return maps

    @staticmethod
    def scan(maps: np.ndarray) -> np.ndarray:
        """Row k: the map of all chunks up to and with k, by composing at doubling distances."""
        maps, step = maps.copy(), 1
        while step < len(maps):
            maps[step:] = np.take_along_axis(maps[step:], maps[:-step], axis=1)
            step *= 2
        return maps

    def run(self, symbols: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each symbol."""
        n = len(symbols)
        padded = np.full(-(-n // CHUNK) * CHUNK, len(self.after) - 1, np.uint8)
        padded[:n] = symbols
        chunks = padded.reshape(-1, CHUNK)
        before = np.full(len(chunks), self.start, np.uint8)
        before[1:] = self.scan(self.chunk_maps(chunks))[:-1, self.start]
        out, states = np.empty(chunks.shape, bool), self.after.shape[1]
        after, begins = self.after.ravel(), self.begins.ravel()
        for k in range(CHUNK):
            at = chunks[:, k].astype(np.int32) * states + before
            out[:, k] = begins[at]
            before = after[at]
        return out.ravel()[:n]


class TokenMachine:
    """Token counts of byte pieces under byte-pair merges, ``merges`` in order of priority as pairs of byte strings."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.made: list[int] = [-1] * 256  # priority of the merge that makes a token
        number = {bytes([b]): b for b in range(256)}
        self.merge: dict[int, int] = {}  # by both tokens as one number
        for priority, (left, right) in enumerate(merges):
            pair = number[left], number[right]
            if left + right in number:
                raise ValueError("two merges make one token")
            number[left + right] = len(self.parts)
            self.merge[pair[0] << 24 | pair[1]] = priority
            self.parts.append(pair)
            self.made.append(priority)
        self._trie(number)
        self.ends = [self._border(t, 1) for t in range(len(self.parts))]
        self.starts = [self._border(t, 0) for t in range(len(self.parts))]
        self.clear()

    def _trie(self, number: dict[bytes, int]) -> None:
        """Children by node and byte, and the token that each node spells; the root is 0."""
        self.child: dict[int, int] = {}
        self.token, self.open = [-1], [True]
        for word, token in number.items():
            node = 0
            for b in word:
                self.open[node] = True
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.open.append(False)
                node = self.child[key]
            self.token[node] = token

    def _border(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one border of a token while it is made, with the priority of the merge that ends each."""
        out, until = [], 1 << 60
        while True:
            out.append((token, until))
            if self.parts[token] is None:
                return out
            until = self.made[token]
            token = self.parts[token][side]

    def clear(self) -> None:
        self.states: list[tuple] = []
        self.known: dict[tuple, int] = {}
        self.transitions: dict[int, tuple[int, int]] = {}
        self.follows: dict[int, bool] = {}
        self.keys = np.full(1 << _SLOT_BITS, -1, np.int64)  # the transitions again, as a hash table for whole arrays
        self.next = np.zeros(1 << _SLOT_BITS, np.int32)
        self.change = np.zeros(1 << _SLOT_BITS, np.int16)
        self._state(((0, -1, 0),))

    def _state(self, items: tuple) -> int:
        if items not in self.known:
            self.known[items] = len(self.states)
            self.states.append(items)
        return self.known[items]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart: of equal merges the leftmost comes first."""
        key = left << 24 | right
        known = self.follows.get(key)
        if known is None:
            known = self.follows[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        starts, merge = self.starts[right], self.merge
        for x, x_until in self.ends[left]:
            x <<= 24
            for y, y_until in starts:
                at = merge.get(x | y)
                if at is not None and at < x_until and at <= y_until:
                    return False
        return True

    def _compile(self, key: int) -> tuple[int, int]:
        byte, moved, last, change = key & 0xFF, [], -1, 0
        child, token_at = self.child, self.token
        for node, token, since in self.states[key >> 8]:  # the longest first
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            made = token_at[node]
            if last < 0 and made >= 0 and (token < 0 or self.may_follow(token, made)):
                last, change = made, 1 - since
            if self.open[node]:
                moved.append((node, token, since))
        items = tuple([(node, token, since + change) for node, token, since in moved])
        self.transitions[key] = out = self._state((*items, (0, last, 0))), change
        slot = (key * _SPREAD & _MASK) >> (64 - _SLOT_BITS)
        while self.keys[slot] >= 0:
            slot = (slot + 1) % len(self.keys)
        self.keys[slot], self.next[slot], self.change[slot] = key, *out
        return out

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each transition; of its own place in an empty slot where it isn't compiled yet."""
        slots = ((keys.astype(np.uint64) * np.uint64(_SPREAD)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        there = self.keys[slots]
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            there = self.keys[slots[open_]]
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return slots

    def _walk(self, piece: bytes) -> int:
        state = total = 0
        for at in range(0, len(piece), _STRIDE):
            if len(self.transitions) > MAX_TRANSITIONS:  # go on from the same state in a new machine
                items = self.states[state]
                self.clear()
                state = self._state(items)
            for byte in piece[at : at + _STRIDE]:
                key = state << 8 | byte
                state, change = self.transitions.get(key) or self._compile(key)
                total += change
        return total

    def count(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece ``data[start : start + length]``: all pieces take a step together, long ones go alone."""
        out = np.zeros(len(starts), np.int64)
        for k in np.flatnonzero(lengths > LONG_PIECE).tolist():
            out[k] = self._walk(data[starts[k] : starts[k] + lengths[k]].tobytes())
        if len(self.transitions) > MAX_TRANSITIONS:
            self.clear()
        order = np.argsort(np.where(lengths > LONG_PIECE, 0, -lengths), kind="stable")
        ends = np.where(lengths > LONG_PIECE, 0, lengths)[order]
        first, state, total = starts[order], np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for k in range(int(ends[0]) if len(ends) else 0):
            m = int(np.searchsorted(-ends, -k, side="left"))
            keys = state[:m] << 8 | data[first[:m] + k]
            slots = self._find(keys)
            new = self.keys[slots] < 0
            if new.any():
                for key in np.unique(keys[new]).tolist():
                    self._compile(key)
                slots[new] = self._find(keys[new])
            state[:m] = self.next[slots]
            total[:m] += self.change[slots]
        out[order] += total
        return out
