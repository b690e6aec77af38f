"""The corpus pipeline over ``documents``: language ID, near-dedup, decontamination, PII, mixing.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all that its predecessor
kept. All but the last return the columns of documents. How each stage treats nulls,
repeated rows and empty tables is told in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import decontaminate, language, minmax, mixing, pii
from waymark.llm.common import cut, free_name

#: The model of stage 1 and the clusters of stage 2 can't be said in SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; lang is the language told."""
    return language.keep_identified(docs, language.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return minmax.drop_near_duplicates(docs, size=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms under the session's key (pii.KEY_SETTING); n_chars follows the new text."""
    found = free_name(docs, "pii")
    changed = pii.pseudonymise(docs, pii.session_key(spark), column=found)
    length = F.when(F.size(found) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", length).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents repeated to their source's rate, numbered by mix_copy."""
    own = [c for c in docs.columns if c not in mixing.ADDED]
    return mixing.emit(mixing.plan_mix(docs)).select(*own, "mix_copy")


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("pii", pseudonymise),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each stage's rows are written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
