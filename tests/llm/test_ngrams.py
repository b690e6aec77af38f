from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_minmax import brute, near, shingles

from waymark.llm import ngrams
from waymark.llm.tokens import Texts, shingle_sets, words_of

DOCS = "doc_id bigint, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("size,percent,paired", [(5, 80, 32), (5, 80, 2), (3, 85, 4)])
def test_components_match_all_pairs(spark, sf, monkeypatch, size, percent, paired):
    monkeypatch.setattr(ngrams, "PAIRED", paired)  # small ones too, so that rests are compared in blocks
    rng = random.Random(size + paired)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    for group in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 200))]
        for k in range(30):
            rows.append((1000 + 100 * group + k, " ".join(near(rng, base, rng.randrange(8)))))
    passage = [f"p{k}" for k in range(60)]
    for k in range(60):  # one passage in texts of many lengths
        rows.append((5000 + k, " ".join([f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(40))] + passage)))
    rng.shuffle(rows)
    out = ngrams.link(frame(spark, rows), size, percent).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def pages(n, unique):
    """n pages of one template of 200 words with so many words of their own at the end."""
    own = F.transform(F.sequence(F.lit(1), F.lit(unique)), lambda i: F.concat_ws("_", "id", i))
    template = " ".join(f"t{i}" for i in range(200))
    return lambda spark: spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(template), F.array_join(own, " ")).alias("text"))


@pytest.mark.parametrize("unique,joined", [(45, False), (27, False), (20, True)])
def test_templates_cost_no_squares(spark, monkeypatch, unique, joined):
    """Pages below the threshold aren't even paired, pages above it are checked a few times each."""
    seen = {}

    def counted(pairs, *rest):
        out = ngrams.cut(plain(pairs, *rest), "counted")
        seen.setdefault("listed", 0)
        seen["listed"] += pairs.count()
        return out

    def confirmed(links, sets, percent):
        seen["checked"] = seen.get("checked", 0) + links.count()
        return check(links, sets, percent)

    def blocks(members, sets, percent):
        seen["members"] = members.count()
        return compare(members, sets, percent)

    plain, check, compare = ngrams.sieve, ngrams.confirm, ngrams.compare_blocks
    monkeypatch.setattr(ngrams, "sieve", counted)
    monkeypatch.setattr(ngrams, "confirm", confirmed)
    monkeypatch.setattr(ngrams, "compare_blocks", blocks)
    n = 1500
    got = ngrams.link(pages(n, unique)(spark)).groupBy("component_id").count().count()
    assert got == (1 if joined else n)
    assert seen["listed"] <= (3 * n if joined else 0) and seen["checked"] <= seen["listed"] and seen["members"] == 0


def grams_of(text):
    data = text.encode()
    return shingle_sets(words_of(Texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))), 5)[0]


def test_the_bound_is_never_too_low():
    """The sieve drops no pair that shares enough, whatever the counters say."""
    rng = random.Random(4)
    tight = 0
    for _ in range(400):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 150))]
        one, two = near(rng, base, rng.randrange(3)), near(rng, base, rng.randrange(3))[: max(5, len(base) - rng.randrange(12))]
        a, b = grams_of(" ".join(one)), grams_of(" ".join(two))
        counts = np.random.default_rng(rng.randrange(99)).integers(0, rng.choice([1, 3, 1000]), ngrams.SLOTS).astype(np.uint32)
        heads = [x[np.lexsort((x, counts[ngrams.slots_of(x)]))][: ngrams.prefixes(len(x), 80)[0]] for x in (a, b)]
        bins = [ngrams.bins_of(x) for x in (a, b)]
        shared = len(np.intersect1d(a, b))
        bound = ngrams.most_common(*heads, len(a), len(b), *bins, counts)
        assert shared <= bound <= min(len(a), len(b))
        assert len(shingles(" ".join(one), 5)) == len(a)
        if 100 * shared >= 80 * (len(a) + len(b) - shared):
            longer = (len(b), 1) > (len(a), 0)
            short, long = (heads[0], heads[1]) if longer else (heads[1], heads[0])
            assert set(short[: ngrams.prefixes(min(len(a), len(b)), 80)[1]]) & set(long)
            tight += 1
    assert tight > 50


def test_counters_hold_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = np.zeros(ngrams.SLOTS, np.int64)
    for row in docs.select("text").collect():
        data = (row.text or "").encode()
        words = words_of(Texts(np.frombuffer(data, np.uint8), np.array([0, len(data)])))
        np.add.at(want, ngrams.slots_of(ngrams.shingles_of(words, 5)[0]), 1)
    assert (ngrams.gram_counts(docs.repartition(7), 5) == want).all()


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (9, "Same  few"), (5, "same few"), (5, "same few"), (None, "same few"), (7, "one")]
    rows += [(8, "w " * 300_000), (8, "another text of this id"), (4, "Another text of this id")]
    out = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in ngrams.link(frame(spark, rows)).collect())
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5), (5, 1, 5), (9, 1, 5), (None, 1, None), (7, 1, 7), (8, 1, 8), (8, 1, 4), (4, 1, 4)]
    assert out == sorted(map(str, want))
    assert ngrams.link(frame(spark, [])).count() == 0


def test_clashing_columns_are_ignored(spark):
    docs = frame(spark, [(1, "a b c d e f"), (2, "a b c d e f")])
    for name in ("node", "class", "prefix", "root", "n", "band", "text_", "segment"):
        docs = docs.withColumn(name, F.lit("x"))
    assert sorted((r.doc_id, r.component_id) for r in ngrams.link(docs).collect()) == [(1, 1), (2, 1)]
