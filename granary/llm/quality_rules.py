"""Quality rules over whole texts, in DataFrame functions only.

Base rules count words, symbols, repeated lines and words in repeated three-word windows. The method is a hashed n-gram
log-likelihood ratio: words and word pairs fall into ``BUCKETS`` hash buckets; one multinomial comes from trusted
documents and one from all documents; a document's score is the mean log ratio of its n-grams, and it is kept when the
score reaches a fixed threshold.

    ratio(b) = log((t_b + PRIOR * s_b) / (T + PRIOR)) - log(s_b),  s_b = (r_b - 1) / R

with t, r the bucket counts and T, R their totals. The one taken off is the judged occurrence itself, which is no
evidence against its document. The trusted multinomial is smoothed towards the raw one, so a bucket without evidence
has ratio 0.

Scale: counts are one pass with map-side combine into ``BUCKETS`` rows. The trusted documents are a sample of at most
``TRUSTED_ROWS`` labelled ones (the first in order of a hash of their ids), so the broadcast of their ids is bounded;
the raw counts cover every document. The ratios are one row of ``BUCKETS`` numbers. Scoring is map-only: arrays of a
row are hashed, sorted and compared in the row, nothing is exploded or shuffled.

Defined cases: a null text has no words; no words fails the base rules; without trusted rows every ratio is 0; repeated
rows are judged each on their own; an empty table stays empty; other columns are ignored or handed on untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
TRUSTED_ROWS = 10_000
PRIOR = float(1 << 18)
THRESHOLD = -0.1
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"
_NOT_SYMBOLS = r"[^#*$%&|<>]+"
_WINDOW = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also when the body names it in other lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES))


def _tail(values: Column) -> Column:
    return F.slice(values, F.lit(2), F.size(values))


def _pairs(hashes: Column) -> Column:
    """Hash of each element with the next one; the last goes with nothing."""
    return F.zip_with(hashes, _tail(hashes), lambda a, b: F.xxhash64(a, b))


def hashes(words_: Column) -> Column:
    """``one``: a hash per word; ``two``: a hash per word and its successor (the last one stands alone)."""
    one = F.transform(words_, lambda w: F.xxhash64(w))
    return let(one, lambda h: F.struct(h.alias("one"), _pairs(h).alias("two")))


def repeated_words(two: Column) -> Column:
    """Words in three-word windows that occur twice or more in the text.

    A window's hash is the hash of its two pair hashes. Hash and position share one long per window, sorted: equal
    neighbours are repeated windows. The words are the size of the union of [position, position + 3).
    """

    def packed(windows: Column) -> Column:
        bits = F.length(F.bin(F.size(windows)))
        return let(bits, lambda b: F.struct(b.alias("bits"), F.sort_array(_keys(windows, b)).alias("keys")))

    def _keys(windows: Column, b: Column) -> Column:
        return F.transform(windows, lambda h, i: F.call_function("shiftleft", h, b).bitwiseOR(i.cast("long")))

    def positions(p: Column) -> Column:
        high = lambda k: F.call_function("shiftright", k, p["bits"])
        at = lambda k: k - F.call_function("shiftleft", high(k), p["bits"])
        keys = p["keys"]
        both = F.zip_with(keys, _tail(keys), lambda a, b: F.when(high(a) == high(b), F.array(at(a), at(b))))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))

    def covered(at: Column) -> Column:
        steps = F.zip_with(at, _tail(at), lambda a, b: F.coalesce(F.least(b - a, F.lit(_WINDOW).cast("long")), F.lit(_WINDOW).cast("long")))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def counted(windows: Column) -> Column:
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)  # most texts have none and are done here
        return F.when(repeats, let(let(packed(windows), positions), covered)).otherwise(F.lit(0).cast("long"))

    return let(F.slice(_pairs(two), F.lit(1), F.greatest(F.size(two) - (_WINDOW - 1), F.lit(0))), counted)


def base_counts(text: Column, words_: Column, two: Column) -> dict[str, Column]:
    """Base counts of a text that is not null, from its words and the hashes of its word pairs."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_SPACE)) != "")
    return {
        "n_words": F.size(words_).cast("long"),
        "word_chars": F.length(F.array_join(words_, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, _NOT_SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(two),
    }


def _grams(h: Column) -> Column:
    """Hashes of the words and of the pairs (the last word's pair with nothing is left out)."""
    return F.concat(h["one"], F.slice(h["two"], F.lit(1), F.greatest(F.size(h["two"]) - 1, F.lit(0))))


def _bucket(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of at most ``rows`` documents labelled as good and not toxic, in order of a hash of the id."""
    good = labels.filter("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def log_ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: ``ratios``, an array of ``BUCKETS`` numbers (0 where no document has the bucket)."""
    spark = docs.sparkSession
    good = trusted_ids(labels).select(F.col("doc_id").alias("good_id"))  # at most TRUSTED_ROWS ids
    rows = docs.select("doc_id", "text").join(F.broadcast(good), F.col("doc_id") == F.col("good_id"), "left")
    grams = rows.select(
        F.col("good_id").isNotNull().cast("long").alias("good"),
        F.explode(let(hashes(words(F.col("text"))), _grams)).alias("gram"),
    )
    counts = grams.groupBy(_bucket(F.col("gram")).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("trusted"))
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    model = every.agg(  # BUCKETS rows
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "trusted"))).alias("counts"),
        F.sum("raw").alias("R"),
        F.sum("trusted").alias("T"),
    )

    def ratio(x: Column) -> Column:
        share = (x["raw"] - 1) / F.col("R")
        value = F.log((x["trusted"] + PRIOR * share) / (F.col("T") + PRIOR)) - F.log(share)
        return F.when(x["raw"] > 1, value).otherwise(F.lit(0.0))

    return model.select(F.transform("counts", ratio).alias("ratios"))


def _score(grams: Column, ratios: Column) -> Column:
    def mean(x: Column) -> Column:
        total = F.aggregate(x["g"], F.lit(0.0), lambda acc, g: acc + F.get(x["r"], _bucket(g)))
        return F.when(F.size(x["g"]) > 0, total / F.size(x["g"])).otherwise(F.lit(0.0))

    return let(F.struct(grams.alias("g"), ratios.alias("r")), mean)


def judgement(text: Column, ratios: Column, threshold: float = THRESHOLD) -> Column:
    """Struct of the base counts, ``base_failed``, ``score`` and ``kept`` of a text."""

    def judged(x: Column) -> Column:
        counts = base_counts(x["text"], x["words"], x["h"]["two"])
        return F.struct(*(c.alias(k) for k, c in counts.items()), _score(_grams(x["h"]), x["ratios"]).alias("score"))

    def verdict(c: Column) -> Column:
        repeats = F.lit(100) * c["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * c["n_words"]
        failed = (c["n_words"] < MIN_WORDS) | repeats
        return c.withField("base_failed", failed).withField("kept", ~failed & (c["score"] >= threshold))

    # structs are built from lambda variables only: a field added to an expression would repeat it for every field
    given = F.struct(F.coalesce(text, F.lit("")).alias("text"), words(text).alias("words"), ratios.alias("ratios"))
    prepared = let(given, lambda x: F.struct(x["text"].alias("text"), x["words"].alias("words"), x["ratios"].alias("ratios"), hashes(x["words"]).alias("h")))
    return let(let(prepared, judged), verdict)


_RATIOS = "__quality_rules_ratios"  # never a name of the caller's columns


def rate(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and the judgement's fields for every document."""
    rows = docs.select("doc_id", "text", log_ratios(docs, labels).scalar().alias(_RATIOS))
    judged = judgement(F.col("text"), F.col(_RATIOS), threshold)
    return rows.select("doc_id", judged.alias("j")).select("doc_id", "j.*")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, all their columns as they were."""
    rows = docs.select("*", log_ratios(docs, labels).scalar().alias(_RATIOS))
    return rows.filter(judgement(F.col("text"), F.col(_RATIOS), threshold)["kept"]).drop(_RATIOS)
