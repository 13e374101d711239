"""Repair of conversation structure: the cheapest edits that make a conversation alternate, by an integer-minimum DP.

A conversation is well formed when its role initials are ``(s?(ua)+)?``. Every message is kept (0), gets the role user or
assistant (2) or is deleted (3, required for blank and repeated ones); empty messages of either may be inserted anywhere
(2); a message that stays although it breaks off costs 1. Of the cheapest repairs the one whose audit (the edits'
initials in order: Delete, Insert, Keep, Rerole) is least in ASCII wins.

One scalar decides: the high digits of a path's weight carry its cost, below them lie fixed-width digits, one for each
audit letter from the first on, with zeros at the end. Prepending an edit adds its cost and its letter's digit and moves
the other letters down by one place, so the plain minimum over the successors of a state settles cost and ties at once.
States are those of the expression (nothing yet, after s, after u, after a).

A conversation may hold a third of all rows, so its messages are never a group:

1. Positions come from ``number_rows`` (a range partitioning of all rows, in order of conversation and turn), duplicates
   from an aggregate of first positions.
2. The DP runs over blocks of up to ``BLOCK`` messages, each alone, on one code letter a message: for every pair of states the
   cheapest way through. An insert belongs to the kept or reroled message after it (an insert before a deletion is never
   least: the deletion comes first in ASCII), so audits of a block never continue one another and concatenate in order.
3. A fold over a conversation's blocks needs of each the 16 costs and the order of its audits, some bytes a message: it
   picks the states between the blocks. What is cheapest through a whole conversation follows as in one DP.
4. Edits join the texts by block.

Only what the result itself is made of is as long as a conversation: its audit.

Order within a conversation: turn (nulls first), then role and the SHA-256 of the text, so that rows of one turn have a
defined order and copies are neighbours. Defined cases: a null role or text is one space; a role whose first character is
not s, u or a (an empty one too) is legal next to nothing and can't be kept; rows without a conversation id form one
conversation; an empty table has empty results; other columns are ignored; texts may have any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.inventory import number_rows
from granary.session import scratch_path

BLOCK = 512
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 2, 3, 2, 1  # what edits cost, and a message that stays though it breaks off
ROLES = {"u": "user", "a": "assistant"}

START, AFTER_S, AFTER_U, AFTER_A = STATES = range(4)
_STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
# the inserts that end a conversation in each state
_TAIL = {START: "", AFTER_S: "ua", AFTER_U: "a", AFTER_A: ""}
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = " DIKR"
_BITS = 3

# One code letter a message: the initial (x: any other), as a capital if it breaks off, as a digit if it is blank or repeated.
_INITIALS, _BLANKS, _COPIES = "suax", "0123", "4567"
_WHITE = " \t\n\x0b\x0c\r"


def conversation_key(conv_id: Column | str = "conv_id") -> Column:
    """A conversation's id as a string that is never null."""
    conv_id = F.col(conv_id) if isinstance(conv_id, str) else conv_id
    return F.when(conv_id.isNull(), F.lit("none")).otherwise(F.concat(F.lit("id "), conv_id.cast("string")))


# -- the DP of a block ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Edit:
    """One message's edit in a state: its letters (an insert before it included), cost, and what it leads to."""

    letters: str
    cost: int
    after: int
    inserted: str
    role: str  # user or assistant after a rerole


@lru_cache(maxsize=None)  # 16 codes by 4 states
def edits_of(code: str, state: int) -> list[Edit]:
    """What may be done with a message of this code in a state."""
    out = [Edit("D", DELETE, state, "", "")]
    if code in _BLANKS + _COPIES:
        return out
    more = BROKEN if code.isupper() else 0
    for inserted in ("", "u", "a"):
        at = _STEP.get((state, inserted)) if inserted else state
        if at is None:
            continue
        letters, cost, filled = ("I", INSERT, ROLES[inserted]) if inserted else ("", 0, "")
        if (kept := _STEP.get((at, code.lower()))) is not None:
            out.append(Edit(letters + "K", cost + KEEP + more, kept, filled, ""))
        for role in ROLES:
            if (moved := _STEP.get((at, role))) is not None:
                out.append(Edit(letters + "R", cost + REROLE + more, moved, filled, ROLES[role]))
    return out


@lru_cache(maxsize=20_000)
def cheapest(codes: str) -> tuple[tuple[int | None, str | None], ...]:
    """(cost, letters) of the cheapest way through a block from each state to each state (from * 4 + to)."""
    width = 2 * len(codes) * _BITS  # a message has two letters at most
    mask = (1 << width) - 1
    adds: dict[tuple[str, int], int] = {}

    def add(edit: Edit) -> int:
        key = edit.letters, edit.cost
        if key not in adds:
            digits = 0
            for place, letter in enumerate(edit.letters, 1):
                digits |= _DIGIT[letter] << (width - place * _BITS)
            adds[key] = (edit.cost << width) + digits
        return adds[key]

    moves = {code: [[(add(e), len(e.letters) * _BITS, e.after) for e in edits_of(code, q)] for q in STATES] for code in set(codes)}
    out: list[list] = [[None] * 4 for _ in STATES]
    for target in STATES:
        weights: list[int | None] = [None] * 4
        weights[target] = 0
        for code in reversed(codes):
            moved = []
            for options in moves[code]:
                best = None
                for added, shift, after in options:
                    weight = weights[after]
                    if weight is not None:
                        letters = weight & mask
                        weight += added + (letters >> shift) - letters
                        if best is None or weight < best:
                            best = weight
                moved.append(best)
            weights = moved
        for q in STATES:
            out[q][target] = weights[q]
    return tuple((None, None) if w is None else (w >> width, _spelled(w & mask, width)) for row in out for w in row)


def _spelled(digits: int, width: int) -> str:
    letters = []
    for place in range(width - _BITS, -1, -_BITS):
        digit = digits >> place & 7
        if not digit:
            break
        letters.append(_LETTER[digit])
    return "".join(letters)


def walk(codes: str, letters: str, state: int) -> list[tuple[str, str, str]]:
    """(inserted role, edit letter, new role) of each message, from the letters of a way through a block."""
    out, at = [], 0
    for code in codes:
        size = 2 if letters[at] == "I" else 1
        own = letters[at : at + size]
        # letters tell the edit: where a state allows both roles (after an insert it doesn't), only one leads on
        edit = next(e for e in edits_of(code, state) if e.letters == own)
        out.append((edit.inserted, own[-1], edit.role))
        state, at = edit.after, at + size
    return out


def illegal_pairs(initials: str) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def initials_of(codes: str) -> str:
    return codes.lower().translate(str.maketrans(_BLANKS + _COPIES, _INITIALS * 2))


_BLOCKS = "key string, block long, start long, codes string, illegal long, first string, last string, costs array<int>, letters array<string>, ranks array<int>"


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ways through each block, with the order of their letters among the block's."""
    schema = pa.schema([("key", pa.string()), ("block", pa.int64()), ("start", pa.int64()), ("codes", pa.string()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("costs", pa.list_(pa.int32())), ("letters", pa.list_(pa.string())), ("ranks", pa.list_(pa.int32()))])
    for batch in batches:
        rows = []
        for key, block, start, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            costs, letters = zip(*cheapest(codes), strict=True)
            order = {s: k for k, s in enumerate(sorted({s for s in letters if s is not None}))}
            initials = initials_of(codes)
            rows.append((key, block, start, codes, illegal_pairs(initials), initials[0], initials[-1], costs, letters, [order.get(s) for s in letters]))
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# -- the fold over the blocks of a conversation -----------------------------------------------------------------------

_PATHS = "key string, cost long, illegal long, tail string, path array<struct<block: long, before: int, after: int>>"


def fold(costs: list[list[int | None]], ranks: list[list[int | None]]) -> tuple[int, list[int], str]:
    """(cost, states before each block and at the end, inserts at the end) of the cheapest repair.

    As in a block, one scalar per way: its cost above, below it the rank of the block's letters, and last the rank of
    the letters that follow. After each block the four states' letters are ranked anew, which keeps the scalar short.
    """
    total = [INSERT * len(_TAIL[q]) for q in STATES]
    rank = [len(_TAIL[q]) for q in STATES]
    back: list[list[int]] = []
    for block_costs, block_ranks in zip(reversed(costs), reversed(ranks), strict=True):
        best, after = [], []
        for q in STATES:
            ways = []
            for to in STATES:
                cost = block_costs[4 * q + to]
                if cost is not None:
                    ways.append(((cost + total[to]) << 16 | block_ranks[4 * q + to] << 8 | rank[to], to))
            weight, to = min(ways)
            best.append(weight)
            after.append(to)
        total = [w >> 16 for w in best]
        order = {w: k for k, w in enumerate(sorted({w & 0xFFFF for w in best}))}
        rank = [order[w & 0xFFFF] for w in best]
        back.append(after)
    states = [START]
    for after in reversed(back):
        states.append(after[states[-1]])
    return total[START], states, _TAIL[states[-1]]


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    step = pa.struct([("block", pa.int64()), ("before", pa.int32()), ("after", pa.int32())])
    schema = pa.schema([("key", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64()), ("tail", pa.string()), ("path", pa.list_(step))])
    for batch in batches:
        rows = []
        for key, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            cost, states, tail = fold([b["costs"] for b in blocks], [b["ranks"] for b in blocks])
            between = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(blocks, blocks[1:], strict=False))
            path = [{"block": b["block"], "before": p, "after": q} for b, p, q in zip(blocks, states, states[1:], strict=False)]
            rows.append((key, cost, between + sum(b["illegal"] for b in blocks), tail, path))
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_EDITS = "key string, block long, start long, letters string, edits array<struct<inserted: string, edit: string, role: string>>"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edit = pa.struct([("inserted", pa.string()), ("edit", pa.string()), ("role", pa.string())])
    for batch in batches:
        keys, blocks, starts, codes, letters, states = (c.to_pylist() for c in batch.columns)
        edits = [[dict(zip(("inserted", "edit", "role"), e, strict=True)) for e in walk(c, x, q)] for c, x, q in zip(codes, letters, states, strict=True)]
        columns = [pa.array(keys, pa.string()), pa.array(blocks, pa.int64()), pa.array(starts, pa.int64()), pa.array(letters, pa.string()), pa.array(edits, pa.list_(edit))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "block", "start", "letters", "edits"])


# -- the operator -----------------------------------------------------------------------------------------------------


@dataclass
class Repaired:
    """``messages``: what conversations consist of after the repair, one row a message (``conv_id, place, turn, role, text,
    edit``), in order of ``place``. ``summary``: one row per conversation with its faults, cost and audit."""

    messages: DataFrame
    summary: DataFrame


def _faults(numbered: DataFrame) -> DataFrame:
    """One code letter a message, by conversation key and position."""
    visible = F.rtrim("text", F.lit(_WHITE))
    initial = F.substring("role", 1, 1)
    facts = numbered.select(
        "key",
        "position",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (visible == "").alias("blank"),
        F.right(visible, F.lit(1)).isin(".", "!", "?").alias("ended"),
    )
    firsts = numbered.groupBy("key", "role", "digest").agg(F.min("position").alias("position"))
    marked = facts.join(firsts.select("position", F.lit(True).alias("new")), "position", "left")
    code = (
        F.when(F.col("blank"), F.translate("initial", _INITIALS, _BLANKS))
        .when(F.col("new").isNull(), F.translate("initial", _INITIALS, _COPIES))
        .when(~F.col("ended"), F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    return marked.select("key", "position", code.alias("code"))


def _count(letters: str) -> Column:
    """Characters of the codes that are among the letters."""
    return F.sum(F.length(F.regexp_replace("codes", f"[^{letters}]", ""))).cast("long")


def repair(rows: DataFrame, block: int = BLOCK) -> Repaired:
    """Repair the conversations of ``rows`` (``conv_id, turn, role, text``)."""
    spark = rows.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    source = rows.select(
        conversation_key().alias("key"),
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    # number_rows stores the order: every step below reads the same positions
    order = [F.col("key").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    numbered = number_rows(source, order, seq_col="position")
    staged = scratch_path(spark, "conversations")
    of_block = F.floor(F.col("position") / block).cast("long").alias("block")

    listed = F.sort_array(F.collect_list(F.struct("position", "code")))  # a block's messages at most
    joined = F.array_join(F.transform(listed, lambda x: x["code"]), "").alias("codes")
    codes = _faults(numbered).groupBy("key", of_block).agg(F.min("position").alias("start"), joined)
    codes.mapInArrow(_ways, _BLOCKS).write.parquet(f"{staged}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{staged}/blocks")

    of_fold = F.sort_array(F.collect_list(F.struct("block", "illegal", "first", "last", "costs", "ranks")))
    blocks.groupBy("key").agg(of_fold.alias("blocks")).mapInArrow(_folded, _PATHS).write.parquet(f"{staged}/paths")
    paths = spark.read.schema(_PATHS).parquet(f"{staged}/paths")
    steps = paths.select("key", F.inline("path"))
    way = F.get("letters", F.col("before") * len(STATES) + F.col("after"))
    chosen = steps.join(blocks, ["key", "block"]).select("key", "block", "start", "codes", way.alias("letters"), "before")
    chosen.mapInArrow(_edited, _EDITS).write.parquet(f"{staged}/edits")
    edits = spark.read.schema(_EDITS).parquet(f"{staged}/edits")
    return Repaired(_messages(numbered, edits, paths, of_block), _summary(numbered, blocks, edits, paths))


def _messages(numbered: DataFrame, edits: DataFrame, paths: DataFrame, of_block: Column) -> DataFrame:
    edit = F.get("edits", (F.col("position") - F.col("start")).cast("int"))
    rows = numbered.withColumn("block", of_block).join(edits.select("key", "block", "start", "edits"), ["key", "block"])
    rows = rows.select("key", "conv_id", "turn", "role", "text", "position", edit.alias("e"))
    place = F.col("position") * 2
    inserted = F.struct(place.alias("place"), F.lit(None).cast("long").alias("turn"), F.col("e.inserted").alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    role = F.when(F.col("e.edit") == "R", F.col("e.role")).otherwise(F.col("role"))
    own = F.struct((place + 1).alias("place"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.col("text").alias("text"), F.col("e.edit").alias("edit"))
    both = F.when(F.col("e.edit") == "D", F.array()).when(F.col("e.inserted") == "", F.array(own)).otherwise(F.array(inserted, own))
    changed = rows.select("conv_id", F.inline(both))
    # the inserts at the end of a conversation
    ends = numbered.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.max("position").alias("last"))
    tails = paths.filter(F.length("tail") > 0).join(ends, "key")
    name = F.when(F.col("letter") == "u", ROLES["u"]).otherwise(ROLES["a"])
    tails = tails.select("conv_id", "last", F.posexplode(F.split("tail", "")).alias("k", "letter")).filter(F.col("letter") != "")
    tails = tails.select("conv_id", ((F.col("last") + 1) * 2 + F.col("k")).alias("place"), F.lit(None).cast("long").alias("turn"), name.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    return changed.unionByName(tails)


def _summary(numbered: DataFrame, blocks: DataFrame, edits: DataFrame, paths: DataFrame) -> DataFrame:
    turns = numbered.groupBy("key", "turn").agg(F.first("conv_id").alias("conv_id"))
    low, high, distinct = F.min("turn").cast("long"), F.max("turn").cast("long"), F.count("turn")
    # turns at both ends of the range of long integers: the largest number of gaps that fits
    gaps = F.coalesce(F.try_add(F.try_subtract(high, low), 1 - distinct), F.when(distinct > 0, F.lit(2**63 - 1)).otherwise(0))
    gaps = turns.groupBy("key").agg(F.first("conv_id").alias("conv_id"), gaps.alias("gaps"))
    counts = blocks.groupBy("key").agg(_count(_BLANKS).alias("blank"), _count(_COPIES).alias("duplicate"), _count(_INITIALS.upper()).alias("truncated"))
    letters = F.transform(F.sort_array(F.collect_list(F.struct("block", "letters"))), lambda x: x["letters"])
    audits = edits.groupBy("key").agg(F.array_join(letters, "").alias("letters"))
    joined = gaps.join(counts, "key").join(audits, "key").join(paths.drop("path"), "key")
    audit = F.concat("letters", F.repeat(F.lit("I"), F.length("tail")))
    return joined.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", audit.alias("audit"))


def digests(messages: DataFrame) -> DataFrame:
    """SHA-256 of every conversation's ``role:text`` lines, as one stream over its messages in order.

    A hash is a chain over its input, so one task reads a conversation's messages; it holds a batch of them at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chain = None, None
        for batch in batches:
            done = []
            for key, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != current:
                    if chain is not None:
                        done.append((current, chain.hexdigest()))
                    current, chain = key, hashlib.sha256()
                else:
                    chain.update(b"\n")
                chain.update(f"{role}:{text}".encode())
            yield _rows(done)
        if chain is not None:
            yield _rows([(current, chain.hexdigest())])

    def _rows(done: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], names=["key", "repaired_sha256"])

    ordered = messages.select(conversation_key().alias("key"), "role", "text", "place").repartition("key").sortWithinPartitions("key", "place")
    return ordered.select("key", "role", "text").mapInArrow(run, "key string, repaired_sha256 string")


def damage(rows: DataFrame, folds: int = 20) -> DataFrame:
    """Conversations with faults by the CRC-32 of ``conv_id:turn`` (a null as one space): dropped, emptied, unpunctuated,
    repeated and misattributed rows."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    rows = rows.select("conv_id", "turn", part[2].alias("role"), part[3].alias("text"), (F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % folds).alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
