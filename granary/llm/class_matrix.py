"""Wavelet matrix over character classes, with rank queries for arrays of positions.

A small alphabet (a few bits a character) over the characters of many texts at once: ``rank`` answers a whole array of
queries with a few gathers per bit, and ranks of several classes may be added up before a bisection on them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_WORD = 64


class ClassMatrix:
    """Succinct sequence of classes below ``2 ** bits``: per bit a plane of 64-bit words and the ones before each word."""

    def __init__(self, classes: np.ndarray, bits: int):
        self.n, self.bits = len(classes), bits
        self.planes: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        self.zeros: list[int] = []
        row = classes.astype(np.uint8, copy=False)
        for level in range(bits - 1, -1, -1):
            ones = (row >> np.uint8(level)) & np.uint8(1) != 0
            plane = np.zeros((self.n // _WORD + 1) * 8, np.uint8)  # one word more than needed: position n has one
            packed = np.packbits(ones, bitorder="little")
            plane[: len(packed)] = packed
            words = plane.view("<u8")
            self.planes.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(self.n - int(self.before[-1][-1]))
            row = np.concatenate([row[~ones], row[ones]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a level before each position."""
        word = at // _WORD
        mask = (np.uint64(1) << (at % _WORD).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.planes[level][word] & mask)

    def rank(self, kind: int, at: np.ndarray) -> np.ndarray:
        """Characters of class ``kind`` before each position (0 to n)."""
        low, high = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for level in range(self.bits):
            ones_low, ones_high = self._ones(level, low), self._ones(level, high)
            if kind >> (self.bits - 1 - level) & 1:
                low, high = self.zeros[level] + ones_low, self.zeros[level] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return high - low

    def ranks(self, kinds: Sequence[int], at: np.ndarray) -> np.ndarray:
        """Characters of any of the classes before each position."""
        return sum(self.rank(kind, at) for kind in kinds)

    def bisect(self, kinds: Sequence[int], want: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least position in [low, high] with at least ``want`` characters of the classes before it; ``high`` if none."""
        low, high = low.astype(np.int64), high.astype(np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            enough = self.ranks(kinds, middle) >= want
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return high
