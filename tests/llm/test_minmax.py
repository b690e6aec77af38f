from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import graph, minmax

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute(rows, size, percent):
    """component_id by comparing all pairs."""
    rows = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
    return {i: (len(s), find(i)) for i, s in rows}


def near(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_match_all_pairs(spark, sf, size, percent):
    rng = random.Random(size)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for group in range(12):  # chains and stars of copies, some links only just there
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(60, 200))]
        for k in range(30):
            rows.append((1000 + 100 * group + k, " ".join(near(rng, base, rng.randrange(8)))))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = minmax.link(frame, size, percent).collect()
    assert len(out) == len(rows)
    want = brute(rows, size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_block_comparison_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(minmax, "BLOCK_NODES", 16)
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = [(k, " ".join(near(rng, base, rng.randrange(12)))) for k in range(250)]
    out = minmax.link(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows, 3, 85)


def test_repeated_ids_cost_one_set(spark, monkeypatch):
    seen = {}

    def counted(links, sets, percent):
        out = minmax.cut(plain(links, sets, percent), "counted")
        seen.update(links=links.count(), sets=sets.count(), confirmed=out.count())
        return out

    plain = minmax.confirm
    monkeypatch.setattr(minmax, "confirm", counted)
    words = [f"w{i}" for i in range(120)]
    other = words[:60] + ["x"] + words[60:]
    rows = [(1, " ".join(words))] * 1000 + [(2, " ".join(other))] * 1000 + [(3, "a b c d e f")]
    out = minmax.link(spark.createDataFrame(rows, "doc_id bigint, text string")).groupBy("doc_id", "component_id").count().collect()
    assert {tuple(r) for r in out} == {(1, 1, 1000), (2, 1, 1000), (3, 3, 1)}
    assert seen == {"links": 1, "sets": 2, "confirmed": 1}


def test_a_shared_half_makes_no_large_group(spark, monkeypatch):
    """Documents of which half is the same text aren't near-duplicates: what is compared grows as their number does."""
    compared = []

    def counted(members, sets, percent):
        compared.append(members.count())
        return plain(members, sets, percent)

    plain = minmax.compare_blocks
    monkeypatch.setattr(minmax, "compare_blocks", counted)
    common = " ".join(f"c{i}" for i in range(60))
    for n in (1000, 4000):
        docs = spark.range(n).select(
            F.col("id").alias("doc_id"),
            F.concat_ws(" ", F.lit(common), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat_ws("_", "id", i)), " ")).alias("text"),
        )
        assert minmax.link(docs).where("kept").count() == n
    assert compared[1] <= 6 * compared[0] + 1000 and compared[1] < 4000


def test_edge_rows(spark):
    rows = [
        (1, None, "a", None, None),
        (2, "", "a", None, None),
        (3, " \n", "a", None, None),
        (9, "Same  few", "a", None, None),
        (5, "same few", "a", None, None),
        (5, "same few", "a", None, None),
        (None, "same few", "a", None, None),
        (7, "one", "a", None, None),
        (8, "w " * 300_000, "a", None, None),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    out = sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in minmax.link(docs).collect())
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 5, True), (5, 1, 5, True), (9, 1, 5, False)]
    want += [(None, 1, None, True), (7, 1, 7, True), (8, 1, 8, True)]
    assert out == sorted(map(str, want))
    kept = [r.doc_id for r in minmax.drop_near_duplicates(docs).collect()]
    assert sorted(map(str, kept)) == ["1", "2", "3", "5", "7", "8", "None"]
    assert minmax.link(docs.limit(0)).count() == 0
    assert minmax.drop_near_duplicates(docs.limit(0)).count() == 0


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", 1, 2), (2, "a b c", 3, 4)], "doc_id bigint, text string, node int, class int")
    assert [tuple(r) for r in minmax.drop_near_duplicates(docs).collect()] == [(1, "a b c", 1, 2)]


def test_estimate_is_unbiased():
    rng = np.random.default_rng(3)
    hashing = minmax.MinMax(400)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 200, 200))
    one, two = np.concatenate((common, a)), np.concatenate((common, b))
    assert abs(minmax.estimate(hashing.signature(one), hashing.signature(two)) - 0.6) < 0.05


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 501)], "a bigint, b bigint")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, 500: 500, 501: 500}


@pytest.mark.parametrize("nodes, links", [(0, 0), (3, 4), (40, 20), (40, 45), (300, 260), (25, 200)])
def test_components_of_drawn_edges(spark, nodes, links):
    rng = random.Random(links)
    edges = [(rng.randrange(-9, nodes), rng.randrange(-9, nodes)) for _ in range(links)]
    root = {x: x for a, b in edges if a != b for x in (a, b)}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(root.items())


def test_stars_end_after_one_look(spark, monkeypatch):
    edges = spark.range(1, 500).select(F.col("id").alias("a"), F.lit(0).cast("bigint").alias("b"))
    written, whole = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df, name: written.append(name) or whole(df, name))
    assert graph.components(edges).where("root = 0").count() == 500
    assert written == ["edges", "least"]
