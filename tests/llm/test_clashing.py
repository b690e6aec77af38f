"""Further columns with names that the operators use themselves change nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from waymark.llm import decontaminate, language, lattice, licences, quality

NAMES = [
    "word", "words", "hash", "key", "count", "bucket", "score", "base_score", "lang_pred", "held_out", "notices", "family", "start", "end", "n_tokens",
    "n_known", "train_tokens", "kept", "base_failed", "item_id", "item_words", "edits", "first_word", "end_word", "logp", "total", "row", "n", "id",
    "label", "part", "rank", "letter", "model", "value", "script", "n_words",
]


def decontaminated(docs, spark, sf):
    return decontaminate.find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet").withColumns({c: F.lit(1) for c in ("doc_id", "edits", "n")}))


def identified(docs, spark, sf):
    return language.identify(docs, language.train(docs)).select("doc_id", "held_out", "lang_pred", F.round("score", 9).alias("score"))


def licensed(docs, spark, sf):
    return licences.scan(docs, licences.train(docs)).select("doc_id", F.to_json("notices").alias("notices"))


def scored(docs, spark, sf):
    out = lattice.score_documents(docs)
    return out.select("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))


def judged(docs, spark, sf):
    return quality.judge(docs).select("doc_id", "n_words", "base_failed", "kept")


@pytest.mark.parametrize("operator", [decontaminated, identified, licensed, scored, judged])
def test_clashing_columns_change_nothing(spark, sf, operator):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    more = docs.withColumns({c: F.lit("x") if n % 2 else F.lit(7) for n, c in enumerate(NAMES)})
    one, two = (operator(d, spark, sf) for d in (docs, more))
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
