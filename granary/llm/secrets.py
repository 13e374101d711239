"""Secret scan with a trigram inverted index, in DataFrame functions only.

``build_index`` lists, for every trigram that some rule's Boolean query names, the texts (by a 64-bit hash) that hold
it; copies of a text share their postings. ``candidates`` intersects the postings: one aggregate per text tells
which rules' queries hold. ``scan`` joins the candidates to the documents and verifies them with the
expressions; rules without mandatory trigrams scan every text. The index is a superset filter: trigrams are taken from
the lower-cased text, and a hash that two texts share only makes one more candidate, so no span is lost.

A rule's matches are leftmost and non-overlapping; those whose group is shorter than the rule's minimum are dropped
after matching. Positions come from the lengths of the matches and of the pieces between them, in code points.

Scale: the index has a row per text and present trigram; its aggregate combines map-side. The verifying join is on
the text hash; copies that share one are split by the adaptive skew join, as the candidate side has one row per text.
Everything else is map-only.

Defined cases: a null or empty text has no spans; repeated rows are scanned each on their own; an empty table has an
empty result; other columns are ignored or handed on untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.quality_rules import let
from granary.llm.trigrams import trigram_query
from granary.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0
    min_chars: int = 1


def _either(word: str) -> str:
    """A word with its letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(_either, ("password", "passwd", "secret", "token")), f"{_either('api')}_?{_either('key')}"])

# The base kinds in their order, as the contract gives them.
BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Public formats of keys and tokens.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<start:long,kind_no:int,kind:string,end:long>>"


def index_trigrams(rules: Sequence[Rule]) -> list[str]:
    """Trigrams that the rules' queries name, in order."""
    return sorted({t for rule in rules for q in trigram_query(rule.regex) or [] for t in q})


def text_id(text: Column) -> Column:
    return F.xxhash64(text)


def build_index(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Postings (``trigram``, ``text_id``) of the trigrams that the rules ask for."""
    named = F.array(*map(F.lit, index_trigrams(rules)))
    present = let(F.lower(F.col("text")), lambda x: F.filter(named, lambda t: F.contains(x, t)))
    rows = docs.select(text_id(F.col("text")).alias("text_id"), F.explode(present).alias("trigram"))
    return rows.groupBy("trigram", "text_id").agg(F.lit(1).alias("one")).drop("one")


def write_index(docs: DataFrame, path: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The index as a Parquet table whose files are sorted by trigram, so a look-up reads few row groups."""
    build_index(docs, rules).sortWithinPartitions("trigram").write.parquet(path)
    return docs.sparkSession.read.schema("trigram string, text_id long").parquet(path)


def candidates(index: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``text_id`` and ``hits``, the bit set of the rules whose trigram query holds; texts without any are left out."""
    queries = {k: query for k, rule in enumerate(rules) if (query := trigram_query(rule.regex)) is not None}
    counts, holds = [], {}
    for k, query in queries.items():
        for n, one in enumerate(query):  # postings are distinct, so all of a set are there when their number is
            name = f"rule_{k}_{n}"
            counts.append(F.count_if(F.col("trigram").isin(*sorted(one))).alias(name))
            holds[k] = holds.get(k, F.lit(False)) | (F.col(name) == len(one))
    if not counts:
        return index.sparkSession.createDataFrame([], "text_id long, hits long")
    held = index.groupBy("text_id").agg(*counts)
    hits = F.lit(0)
    for k, hold in holds.items():
        hits = hits + F.when(hold, F.lit(1 << k)).otherwise(F.lit(0))
    return held.select("text_id", hits.cast("long").alias("hits")).filter("hits <> 0")


def _pattern(rule: Rule) -> str:
    """The rule's expression; a minimum length goes into a closing run of one class, which changes no match."""
    if rule.group == 0 and rule.min_chars > 1 and rule.regex.count("[") == 1 and rule.regex.endswith("]+"):
        return f"{rule.regex[:-1]}{{{rule.min_chars - rule.regex.index('[')},}}"
    return rule.regex


def _rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of one rule in a text: the pieces between the matches and the matches, summed up."""
    pattern = _pattern(rule)
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    group = F.regexp_extract_all(text, regex, F.lit(rule.group))

    def parts(x: Column) -> Column:
        pieces = F.slice(F.split(x["text"], pattern), 1, F.size(x["found"]))
        sizes = F.zip_with(pieces, x["found"], lambda p, m: F.struct(F.length(p).cast("long").alias("gap"), F.length(m).cast("long").alias("size")))
        return F.zip_with(sizes, x["group"], lambda s, g: s.withField("chars", F.length(g)))

    def sum_up(p: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + x["size"]
            span = F.struct(start.alias("start"), F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"), end.alias("end"))
            kept = F.when(x["chars"] >= rule.min_chars, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
            return F.struct(end.alias("at"), kept.alias("out"))

        return F.aggregate(p, empty, step, lambda acc: acc["out"])

    none = F.array().cast(SPANS)
    both = F.struct(text.alias("text"), found.alias("found"), group.alias("group"))
    return let(both, lambda x: F.when(F.size(x["found"]) == 0, none).otherwise(let(parts(x), sum_up)))


def find_spans(text: Column, hits: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Sorted spans of all rules; a rule with a trigram query is verified where its bit of ``hits`` is set."""
    each = []
    for k, rule in enumerate(rules):
        spans = _rule_spans(text, rule, k)
        if trigram_query(rule.regex) is not None:
            asked = F.coalesce(hits, F.lit(0).cast("long")).bitwiseAND(F.lit(1 << k)) != 0
            spans = F.when(asked, spans).otherwise(F.array().cast(SPANS))
        each.append(spans)
    return F.sort_array(F.concat(*each))


_HITS, _TEXT_ID = "__secrets_hits", "__secrets_text_id"  # never names of the caller's columns


def _with_spans(docs: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    """The documents with their spans in a further column."""
    index = write_index(docs, scratch_path(docs.sparkSession, "trigram-index"), rules)
    found = candidates(index, rules).select(F.col("text_id").alias(_TEXT_ID), F.col("hits").alias(_HITS))
    rows = docs.select("*", text_id(F.col("text")).alias(_TEXT_ID)).join(found, _TEXT_ID, "left")
    spans = find_spans(F.coalesce(F.col("text"), F.lit("")), F.col(_HITS), rules)
    return rows.select(*docs.columns, spans.alias(name))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id``, ``text`` and ``spans`` (start, kind, end in code points) of every document."""
    return _with_spans(docs.select("doc_id", "text"), "spans", rules)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def both(x: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            gap = F.substring(x["text"], (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
            fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"))
            inside = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
            return F.when(s["start"] >= acc["at"], fresh).otherwise(inside)

        done = F.aggregate(x["spans"], start, step)
        return let(done, lambda d: F.concat(d["out"], F.substring(x["text"], (d["at"] + 1).cast("int"), F.length(x["text"]))))

    whole = let(F.struct(text.alias("text"), spans.alias("spans")), both)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


_SPANS = "__secrets_spans"


def mask(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents, all their columns, with the secrets in ``text`` masked."""
    rows = _with_spans(docs, _SPANS, rules)
    return rows.select(*(masked(F.col(c), F.col(_SPANS)).alias(c) if c == "text" else F.col(c) for c in docs.columns))


def duckdb_spans(table: str, rules: Sequence[Rule] = RULES) -> str:
    """DuckDB query of ``doc_id`` and sorted ``spans`` for the whole texts of a table."""
    parts, lists = [], []
    for k, rule in enumerate(rules):
        regex = rule.regex.replace("'", "''")
        parts += [f"regexp_extract_all(t, '{regex}', 0) m{k}", f"regexp_extract_all(t, '{regex}', {rule.group}) g{k}"]
        parts.append(f"regexp_split_to_array(t, '{regex}') p{k}")
        start = f"coalesce(list_sum([length(x) for x in p{k}[1:i]]), 0) + coalesce(list_sum([length(x) for x in m{k}[1:i-1]]), 0)"
        span = f"{{'s': ({start})::bigint, 'n': {k}, 'k': '{rule.kind}', 'e': ({start} + length(m{k}[i]))::bigint}}"
        lists.append(f"[{span} for i in range(1, len(m{k}) + 1) if length(g{k}[i]) >= {rule.min_chars}]")
    every = lists[0]
    for one in lists[1:]:
        every = f"list_concat({every}, {one})"
    return f"""select doc_id, list_sort({every}) spans
 from (select doc_id, {", ".join(parts)} from (select doc_id, coalesce(text, '') t from {table}))"""
