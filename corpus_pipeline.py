"""Training-data pipeline over the documents table: filter, deduplicate, decontaminate, mask secrets, pack.

Every stage takes the documents that the one before has kept and hands on the columns of documents; the last one
returns the packed pieces. ``run`` writes each stage's result as Parquet in the shared checkpoint folder and reads it
again, so a lost executor repeats tasks of one stage only.

Nulls: a null text has no words and goes with the quality rules. Empty tables pass all stages. Repeated rows are copies
of each other, and one stays. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import decontamination, ngram_join, packing, quality_rules, secrets
from granary.llm.settings import prepare
from granary.session import scratch_path

#: Packing needs a tokenizer, which SQL can't express; tests compare with a brute-force version.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, _table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram links form."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows; documents mostly made of them go."""
    return _counted(decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets masked."""
    prepare(spark)
    return _counted(secrets.mask(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 token ids."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", rules),
    ("ngram_join", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
