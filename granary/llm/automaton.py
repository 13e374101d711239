"""Generalised suffix automaton over the words of many items.

States hold the substrings of the items with equal end positions. Besides the usual links the automaton keeps which
items end there, so a match of a given length can name its items. Built for one bounded block of items at a time.
"""

from __future__ import annotations


class SuffixAutomaton:
    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        """``items``: (name, word numbers); ``window``: words of a window (shorter items are windows themselves)."""
        self.window = window
        self.length = [0]
        self.link = [-1]
        self.next: list[dict[int, int]] = [{}]
        self.items: list[set[int]] = [set()]
        self.names = [name for name, _ in items]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._mark(items)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        self.items.append(set())
        return len(self.length) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """The state of the substrings that reach ``target`` from ``state`` by a single edge, made if need be."""
        if self.length[state] + 1 == self.length[target]:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:  # the prefix is known from another item
            return self._split(last, self.next[last][word], word)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, self.next[state][word], word)
        return new

    def _mark(self, items: list[tuple[str, list[int]]]) -> None:
        """Items of every state, the state of each state's suffix of one window, and the short items ending there."""
        short: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(items):
            state = 0
            for word in words:
                state = self.next[state][word]
                up = state
                while up > 0 and k not in self.items[up]:
                    self.items[up].add(k)
                    up = self.link[up]
            if 0 < len(words) < self.window:
                short.setdefault(state, []).append((len(words), k))
        n = len(self.length)
        self.window_state = [-1] * n
        self.short: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for state in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= self.window:
                self.window_state[state] = state if self.length[up] < self.window else self.window_state[up]
            self.short[state] = (self.short[up] if up > 0 else []) + short.get(state, [])

    def run(self, words: list[int]) -> tuple[list[int], list[tuple[int, int]], set[int]]:
        """(longest match, hit spans [first, end), items whose windows occur) of a word run.

        The longest match ending at a word is 0 where it holds no whole window, so it is the same whatever other items
        the automaton has.
        """
        length, link, edges, window = self.length, self.link, self.next, self.window
        state, size = 0, 0
        longest, spans, found = [], [], set()
        for at, word in enumerate(words):
            while state and word not in edges[state]:
                state = link[state]
                size = length[state]
            target = edges[state].get(word)
            if target is None:
                state = size = 0
            else:
                state, size = target, size + 1
            first, match = at + 1, 0
            if size >= window:
                first, match = at + 1 - window, size
                found |= self.items[self.window_state[state]]
            for need, item in self.short[state]:
                if need <= size:
                    found.add(item)
                    first, match = min(first, at + 1 - need), max(match, need)
            longest.append(match)
            if first <= at:
                if spans and spans[-1][1] >= first:
                    spans[-1] = (min(spans[-1][0], first), at + 1)
                else:
                    spans.append((first, at + 1))
        return longest, spans, found
