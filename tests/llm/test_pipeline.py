from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from test_decontaminate import brute as leaks
from test_minmax import brute as groups
from test_pii import brute as masked

from waymark.llm import language, mixing, pii

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_match_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr("test_pii.KEY", pii.OPEN_KEY)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash_dedup", "decontaminate", "pii", "mix_sources"]
    stages = dict(corpus_pipeline.STAGES)
    one = stages["language_id"](spark, docs, sf)
    assert one.columns == columns
    told = language.identify(docs, language.train(docs)).where("NOT rejected").collect()
    assert {(r.doc_id, r.lang) for r in one.collect()} == {(r.doc_id, r.lang_pred) for r in told}
    two = stages["minhash_dedup"](spark, one, sf)
    component = groups([(r.doc_id, r.text) for r in one.collect()], 5, 80)
    assert sorted(r.doc_id for r in two.collect()) == sorted(i for i, (_, c) in component.items() if i == c)
    three = stages["decontaminate"](spark, two, sf)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in leaks([(r.doc_id, r.text) for r in two.collect()], items)}
    assert {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - bad
    four = stages["pii"](spark, three, sf)
    before = {r.doc_id: r for r in three.collect()}
    for r in four.collect():
        assert r.text == masked(before[r.doc_id].text)
        assert r.n_chars == (len(r.text) if r.text != before[r.doc_id].text else before[r.doc_id].n_chars)
    assert all(s.columns == columns for s in (two, three, four))
    five = stages["mix_sources"](spark, four, sf)
    planned = {r.doc_id: r.mix_copies for r in mixing.plan_mix(four).collect()}
    assert {r.doc_id: r.n for r in five.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {
        d: n for d, n in planned.items() if n
    }
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, five.collect()))


def test_clashing_columns_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = ["pii", "kind", "node", "class", "has_letter", "nth", "score", "mix_salt", "mix_source"]
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    docs = docs.union(docs.limit(20))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf)
        if name != "mix_sources":
            assert docs.columns == before.columns
        assert {r.pii for r in docs.select("pii").distinct().collect()} == {0}
    assert docs.groupBy("doc_id", "mix_copy").count().where("count > 1").count() == 0


def test_nulls_and_an_empty_table(spark, sf):
    rows = spark.createDataFrame(
        [
            (1, None, None, None, None),
            (None, "the words of a text that is in the language of the others", None, None, None),
            (2, "", "en", "s", 0),
            (3, "the words of a text", "en", "s", 19),
            (3, "the words of a text", "en", "s", 19),
        ],
        DOCS,
    )
    for docs in (rows, rows.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            docs.collect()
