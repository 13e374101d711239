"""Boolean trigram queries from regular expressions.

A rule's query is a list of alternatives, each a set of trigrams that a text must hold (lower-cased) when that
alternative matches; ``None`` means that no trigram is mandatory and the rule must scan every text. The query follows
from the expression: literals, small character classes and alternatives extend the strings that a match must contain;
whatever has no bounded set of strings ends the run, and the trigrams of a run are required together.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser

MAX_STRINGS = 64  # of a run; a longer list ends it (the query only gets weaker)
MAX_CLASS = 6  # characters of a class that counts as a choice of literals

Query = list[frozenset[str]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _simplify(query: Query) -> Query:
    """Without alternatives that ask for more than another one does."""
    kept: Query = []
    for one in sorted(set(query), key=lambda q: (len(q), sorted(q))):
        if not any(other <= one for other in kept):
            kept.append(one)
    return kept


def _both(a: Query, b: Query) -> Query:
    return _simplify([x | y for x in a for y in b])


class _Run:
    """What must hold of a match so far: ``query`` of closed runs and the possible strings of the open one."""

    def __init__(self):
        self.query: Query = [frozenset()]
        self.strings: set[str] = {""}

    def extend(self, strings: set[str]) -> None:
        joined = {a + b for a in self.strings for b in strings}
        if len(joined) > MAX_STRINGS:
            self.close()
            joined = strings if len(strings) <= MAX_STRINGS else {""}
        self.strings = joined

    def close(self) -> None:
        self.query = _both(self.query, [_trigrams(s) for s in self.strings])
        self.strings = {""}


def _class(members) -> set[str] | None:
    out: set[str] = set()
    for kind, value in members:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < MAX_STRINGS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MAX_CLASS else None


def _exact(items) -> set[str] | None:
    """All strings (lower-cased) that a sequence matches, if they are few."""
    out = {""}
    for kind, value in items:
        if kind is op.LITERAL:
            more = {chr(value).lower()}
        elif kind is op.IN:
            more = _class(value)
        elif kind is op.SUBPATTERN:
            more = _exact(value[3])
        elif kind is op.BRANCH:
            parts = [_exact(p) for p in value[1]]
            more = None if None in parts else set().union(*parts)
        elif kind is op.MAX_REPEAT and value[1] <= 3:
            one = _exact(value[2])
            more, times = (None, None) if one is None else (set(), {""})
            for n in range(int(value[1]) + 1 if one is not None else 0):
                more |= times if n >= value[0] else set()
                times = {a + b for a in times for b in one}
        else:
            more = None
        if more is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _walk(items, run: _Run) -> None:
    for item in items:
        kind, value = item
        strings = _exact([item])
        if strings is not None:
            run.extend(strings)
        elif kind is op.SUBPATTERN:
            _walk(value[3], run)
        elif kind is op.MAX_REPEAT and value[0] >= 1:
            strings = _exact(list(value[2]) * min(int(value[0]), 3))
            if strings is not None:
                run.extend(strings)
                run.close()
            else:
                run.close()
                run.query = _both(run.query, _query(value[2]))
        elif kind is op.BRANCH:
            run.close()
            run.query = _both(run.query, _simplify([q for part in value[1] for q in _query(part)]))
        else:  # optional, unbounded or unknown: nothing is mandatory here
            run.close()


def _query(items) -> Query:
    run = _Run()
    _walk(items, run)
    run.close()
    return run.query


def trigram_query(regex: str) -> Query | None:
    query = _simplify(_query(parser.parse(regex)))
    return None if frozenset() in query or not query else query
