"""Registered queries of the subpackage: ``QUERIES[name](spark, sf_dir)`` and, where SQL can tell, ``ORACLE[name]``."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import conversations, decontamination, fill_middle, html_text, language_id, ngram_join, ordinal, packing, pitman_yor, quality_rules, secrets, token_counts, token_files
from granary.llm.settings import prepare
from granary.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, graded 0 (toxic), 1 (low quality) and 2 (good) by the labels."""
    docs = table(spark, sf_dir, "documents")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    ratings = table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade"))
    return ordinal.classify(docs, ordinal.fit(docs, ratings, n_grades=3))


@register("op2_ngram_join")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies (its smallest doc_id) and the number of documents it is linked to."""
    linked = ngram_join.link(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "class_id", "n_links", "same_set_id")


@register("op3_decontaminate")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items, and the items whose windows occur."""
    found = decontamination.match_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest_match",
    )


@register("op4_pitman_yor")
def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the language model, next to that of smoothed word counts."""
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.fold(F.col("doc_id"), 7) == 2
    shards = pitman_yor.number_of_shards(docs)
    models, corpus = pitman_yor.train(docs.filter(~held_out).select("text"), shards)
    base = F.col("base_sum") - F.col("n_tokens") * F.lit(math.log10(corpus.tokens + corpus.words + 1))
    return pitman_yor.score(docs, models, corpus, shards).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


@register("op5_wavelet_tokens")
def op5_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents in wavelet-matrix shards, read back from the files."""
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path)


_LISTED = "array_to_string([x.k || ':' || x.s || ':' || x.e for x in {0}], ',')"
_OP6 = f"""
select doc_id,
 len([x for x in spans if x.n = 0]) n_assign, len([x for x in spans if x.n = 1]) n_access, len([x for x in spans if x.n = 2]) n_hex,
 sha256({_LISTED.format("[y for y in spans if y.n < 3]")}) base_sha256, {_LISTED.format("spans")} spans
from ({secrets.duckdb_spans("documents")})
"""


@register("op6_secrets", _OP6)
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts of the base kinds and all spans."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind_no"] < len(secrets.BASE_RULES))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(rule.kind) for rule in secrets.BASE_RULES]
    digest = F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.listed(F.col("spans")).alias("spans"))


@register("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn(language_id.training_rows(docs)))
    held_out = language_id.fold(F.col("doc_id"), language_id.HELD_OUT_FOLDS) == language_id.HELD_OUT_FOLD
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, log-likelihood ratio and verdict for every document."""
    rated = quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return rated.select("doc_id", *columns)


@register("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@register("op10_pack")
def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 token ids, one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"))


# The damage (CRC-32 bit by bit), the faults, and the DP over each conversation's rows from the last to the first: per state
# (nothing yet, after s, after u, after a) the least (cost, audit) with the repaired lines that go with it.
_OP11 = r"""
with keyed as (
 select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') txt,
  coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') k
 from conversations),
crc as (
 select *, xor(list_reduce([cast(ascii(x) as bigint) for x in string_split(k, '')],
   lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(c, b)),
   4294967295), 4294967295) % 20 fault
 from keyed),
damaged as (
 select conv_id, turn, case when fault = 4 then 'user' else role end role,
  case when fault = 1 then '' when fault = 2 then regexp_replace(txt, '[.!?]', '', 'g') else txt end txt,
  unnest(case when fault = 3 then [0, 1] else [0] end) copy
 from crc where fault <> 0),
facts as (
 select conv_id, turn, role, txt, rtrim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) seen,
  case when role[1] in ('s', 'u', 'a') then role[1] else 'x' end i,
  row_number() over (partition by conv_id order by turn nulls first, role, sha256(txt), copy) place,
  row_number() over (partition by conv_id, role, txt order by turn nulls first, copy) nth
 from damaged),
coded as (
 select *, case when seen = '' then 'blank' when nth > 1 then 'duplicate' when seen[-1] not in ('.', '!', '?') then 'truncated' else '' end f,
  lag(i) over (partition by conv_id order by place) before
 from facts),
listed as (
 select conv_id, count(*) filter (where f = 'blank') blank, count(*) filter (where f = 'duplicate') duplicate,
  count(*) filter (where f = 'truncated') truncated, count(*) filter (where before || i not in ('su', 'ua', 'au')) illegal,
  coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps,
  list({'i': i, 'f': f, 'line': role || ':' || txt, 'txt': txt} order by place desc) messages
 from coded group by conv_id),
ways as (select [
 [{'n': '', 'w': 's', 'q': 2}, {'n': '', 'w': 'u', 'q': 3}, {'n': 'user:', 'w': 'a', 'q': 4}],
 [{'n': '', 'w': 'u', 'q': 3}, {'n': 'user:', 'w': 'a', 'q': 4}],
 [{'n': '', 'w': 'a', 'q': 4}, {'n': 'assistant:', 'w': 'u', 'q': 3}],
 [{'n': '', 'w': 'u', 'q': 3}, {'n': 'user:', 'w': 'a', 'q': 4}]] ways),
solved as (
 select l.*, list_reduce(messages, lambda v, r: [list_sort(
   [{'c': v[q].c + 3, 'a': 'D' || v[q].a, 't': v[q].t}] ||
   [{'c': v[x.q].c + (case when x.n <> '' then 2 else 0 end) + (case when x.w <> r.i then 2 else 0 end) + (case when r.f = 'truncated' then 1 else 0 end),
     'a': (case when x.n <> '' then 'I' else '' end) || (case when x.w = r.i then 'K' else 'R' end) || v[x.q].a,
     't': (case when x.n <> '' then [x.n] else [] end)
       || [case when x.w = r.i then r.line when x.w = 'u' then 'user:' || r.txt else 'assistant:' || r.txt end] || v[x.q].t}
    for x in ways[q] if r.f not in ('blank', 'duplicate') and (x.w = r.i or x.w <> 's')])[1] for q in [1, 2, 3, 4]],
   [{'c': 0, 'a': '', 't': cast([] as varchar[])}, {'c': 4, 'a': 'II', 't': ['user:', 'assistant:']},
    {'c': 2, 'a': 'I', 't': ['assistant:']}, {'c': 0, 'a': '', 't': cast([] as varchar[])}])[1] best
 from listed l, ways)
select o.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
 coalesce(illegal, 0) illegal, cast(coalesce(best.c, 0) as bigint) "cost", coalesce(best.a, '') audit,
 sha256(coalesce(array_to_string(best.t, chr(10)), '')) repaired_sha256
from (select distinct conv_id from conversations) o left join solved s on o.conv_id is not distinct from s.conv_id
"""


@register("op11_conversations", _OP11)
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired messages of every conversation, after the stated damage."""
    rows = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damage(rows))
    key = conversations.conversation_key().alias("key")
    every = rows.select("conv_id").distinct().select(key, "conv_id")
    found = repaired.summary.select(key, *(c for c in repaired.summary.columns if c != "conv_id"))
    joined = every.join(found, "key", "left").join(conversations.digests(repaired.messages), "key", "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


_OP12 = r"""
with d as (
 select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[ \t-\r]*[^ \t-\r]+|[ \t-\r]+') u,
  sha256('42:' || coalesce(cast(doc_id as varchar), '')) h
 from documents),
e as (
 select *, len(u) n, cast('0x' || h[1:8] as bigint) h1, cast('0x' || h[9:16] as bigint) h2,
  cast('0x' || h[17:24] as bigint) h3, cast('0x' || h[25:32] as bigint) h4 from d),
f as (
 select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
  case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
       when h4 % 100 < 80 then 'spm' else 'psm' end form from e),
g as (
 select *, array_to_string(u[1:a], '') p, array_to_string(u[a + 1:b], '') m, array_to_string(u[b + 1:], '') s from f)
select doc_id, n, form, case when form <> 'plain' then length(p) end prefix_chars, case when form <> 'plain' then length(m) end middle_chars,
 sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
  else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256, sha256(p || m || s) restored_sha256
from g
"""


@register("op12_fill_middle", _OP12)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in fill-in-middle form, with digests of the output and of the text rebuilt from it."""
    done = fill_middle.transform(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored("output", "form").cast("binary"), 256).alias("restored_sha256"),
    )


@register("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than 1024 tokens."""
    counted = token_counts.count(table(spark, sf_dir, "documents"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"))
