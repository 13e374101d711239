"""Conversation repair against a search over all edits, against a plain DP with tuples, and over blocks of any size."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

from granary.llm import conversations as conv
from granary.llm.queries import QUERIES
from tests.llm.helpers import SF

FORM = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string, key string, position long, block long"


def faults(rows):
    """Fault of each (turn, role, text) row in order."""
    out, seen = [], set()
    for _, role, text in rows:
        visible = text.strip(WHITE)
        if not visible:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if visible[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def searched(rows):
    """(cost, audit, lines) of the cheapest repair among all edits with at most one insert before each row and two at the end."""
    best = None
    found = faults(rows)
    per_row = []
    for (_, role, text), fault in zip(rows, found, strict=True):
        options = [("D", 3, [])]
        if fault not in ("blank", "duplicate"):
            more = 1 if fault == "truncated" else 0
            options += [("K", more, [(role, text)])] + [("R", 2 + more, [(r, text)]) for r in ("user", "assistant")]
        inserts = [("", 0, [])] + [("I", 2, [(r, "")]) for r in ("user", "assistant")]
        per_row.append([(i[0] + o[0], i[1] + o[1], i[2] + o[2]) for i in inserts for o in options])
    ends = [("", 0, []), *[("I", 2, [(r, "")]) for r in ("user", "assistant")], ("II", 4, [("user", ""), ("assistant", "")])]
    for way in itertools.product(*per_row, ends):
        lines = [m for w in way for m in w[2]]
        initials = "".join(role[:1] or "?" for role, _ in lines)
        if FORM.fullmatch(initials):
            key = (sum(w[1] for w in way), "".join(w[0] for w in way))
            if best is None or key < best[0]:
                best = key, [f"{r}:{t}" for r, t in lines]
    return *best[0], best[1]


def planned(rows):
    """The same by a DP over (cost, audit, lines) tuples, for longer conversations."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    v = {0: (0, "", ()), 1: (4, "II", ("user:", "assistant:")), 2: (2, "I", ("assistant:",)), 3: (0, "", ())}
    for (_, role, text), fault in zip(reversed(rows), reversed(faults(rows)), strict=True):
        new = {}
        for q in range(4):
            options = [(v[q][0] + 3, "D" + v[q][1], v[q][2])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for ins in ("", "u", "a"):
                    p = step.get((q, ins)) if ins else q
                    if p is None:
                        continue
                    pre = (2, "I", (names[ins] + ":",)) if ins else (0, "", ())
                    moves = [("K", 0, role[:1], role)] + [("R", 2, k, name) for k, name in names.items()]
                    for letter, cost, initial, name in moves:
                        n = step.get((p, initial))
                        if n is not None:
                            options.append((v[n][0] + pre[0] + cost + more, pre[1] + letter + v[n][1], (*pre[2], f"{name}:{text}", *v[n][2])))
            new[q] = min(options)
        v = new
    return v[0][0], v[0][1], list(v[0][2])


def in_order(rows):
    """Rows of one conversation in the operator's order."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def expected(rows, solve):
    """{conversation: summary} of (conv_id, turn, role, text) rows that went through no damage."""
    out = {}
    for key in {r[0] for r in rows}:
        own = in_order([(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == key])
        found, initials = faults(own), [r[:1] for _, r, _ in own]
        turns = [t for t, _, _ in own if t is not None]
        cost, audit, lines = solve(own)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out[key] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def repaired(spark, rows, block=conv.BLOCK):
    frame = spark.createDataFrame([(*r, "x", -1, -1) for r in rows], COLUMNS)
    done = conv.repair(frame, block)
    digest = {r["key"]: r["repaired_sha256"] for r in conv.digests(done.messages).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    out = {}
    for r in done.summary.collect():
        key = "none" if r["conv_id"] is None else f"id {r['conv_id']}"
        out[r["conv_id"]] = (*tuple(r)[1:], digest.get(key, empty))
    return out


def some_rows(seed, conversations, length, roles=("user", "assistant", "system", "tool", None, "", "u", "Assistant")):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", " ", "", None, "a\nb?", "漢。", "end. \t\n", "\x1c", "x"]
    rows = []
    for c in conversations:
        for t in range(rnd.randint(1, length)):
            role = rnd.choice(roles) if rnd.random() < 0.5 else ("user", "assistant")[t % 2]
            rows.append((c, rnd.choice([t, t, t, None, t + 3]), role, rnd.choice(texts)))
    return rows


def test_against_all_edits(spark):
    rows = some_rows(1, [*range(120), None], 4)
    assert repaired(spark, rows) == expected(rows, searched)


def test_blocks_of_any_size(spark):
    rows = some_rows(2, [*range(30), None], 30)
    want = expected(rows, planned)
    for block in (1, 2, 7, 512):
        assert repaired(spark, rows, block) == want


def test_plain_dp_is_the_search():
    for seed in range(60):
        rows = in_order([(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in some_rows(seed + 100, [1], 4)])
        assert planned(rows) == searched(rows)


def test_one_conversation_of_many_rows(spark):
    rnd = random.Random(6)
    rows = [(5, t, rnd.choice(["user", "assistant", "tool"]), f"{rnd.random()}" + rnd.choice([".", ""])) for t in range(3000)]
    rows += [(6, 0, "user", "Hi."), (6, 1, "assistant", "Ho.")]
    found = repaired(spark, rows)
    assert found == expected(rows, planned)
    assert found[6][5:7] == (0, "KK")


def test_messages_are_the_repair(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "You?"), (1, 2, "assistant", "cut"), (1, 2, "assistant", "cut")]
    frame = spark.createDataFrame([(*r, "x", -1, -1) for r in rows], COLUMNS)
    done = conv.repair(frame)
    messages = [(r["turn"], r["role"], r["text"], r["edit"]) for r in done.messages.orderBy("place").collect()]
    assert messages == [(0, "user", "Hi.", "K"), (None, "assistant", "", "I"), (1, "user", "You?", "K"), (2, "assistant", "cut", "K")]
    assert done.summary.first()["audit"] == "KIKKD"


def test_extreme_turns_repeated_rows_and_empty_table(spark):
    rows = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b."), (2, 4, "user", "a."), (2, 4, "user", "a."), (3, None, None, None)]
    found = repaired(spark, rows)
    assert found[1][0] == 2**63 - 1 and found[2][:3] == (0, 0, 1) and found[3] == (0, 1, 0, 0, 0, 3, "D", hashlib.sha256(b"").hexdigest())
    assert repaired(spark, []) == {}


def test_damage(spark):
    rows = [(c, t, "assistant", f"Text {c}. Is it? {t}") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    frame = spark.createDataFrame([(*r, "x", -1, -1) for r in rows], COLUMNS)
    want = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want += [(c, t, "user" if fault == 4 else role or " ", text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert sorted(map(tuple, conv.damage(frame).collect()), key=repr) == sorted(want, key=repr)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    damaged = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in conv.damage(rows).collect()]
    want = expected(damaged, planned)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    every = {r["conv_id"] for r in rows.select("conv_id").distinct().collect()}
    found = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op11_conversations"](spark, SF).collect()}
    assert found == {c: want.get(c, nothing) for c in every}
