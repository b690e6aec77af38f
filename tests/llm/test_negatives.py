from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.llm import negatives as N

ROWS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=5):
    """The query's rows by plain comparison, with Python's integers."""
    held = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in e])
        held[i] = min(held.get(i, row), row)
    out = []
    for a, (own, q) in held.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in held.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if held[i][0] == own][:k]:
            fit = [i for i in order if held[i][0] != own and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, rank, n, score[p], score[n]) for rank, n in enumerate(fit[:k], 1)]
    return sorted(out)


def mined(spark, rows, kind=ROWS):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    frame = spark.createDataFrame(rows, kind)
    return sorted(map(tuple, N.hard_negatives(N.valid_rows(frame, label), F.col("vec_id") % 100 == 0).collect()))


@pytest.mark.parametrize("dims,spread", [(2, 1.0), (3, 0.1), (24, 1.0)])
def test_matches_plain_comparison(spark, monkeypatch, dims, spread):
    """Several parts and blocks; in few dimensions the annuli rule out buckets and leaves."""
    for name, value in (("PART", 64), ("BUCKET", 8), ("BLOCK", 4), ("SAMPLE", 300)):
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(1500, dims)) * spread + rng.normal(size=(6, dims))[rng.integers(0, 6, 1500)]
    rows = [(i, [float(v) for v in x[i]], int(rng.integers(0, 4))) for i in range(1500)]
    assert mined(spark, rows) == brute(rows)


def test_copies_ties_and_odd_rows(spark, monkeypatch):
    for name, value in (("PART", 50), ("BUCKET", 8), ("BLOCK", 3)):
        monkeypatch.setattr(N, name, value)
    rng = random.Random(5)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same, i % 3) for i in range(300)]  # a third and more are one vector: all ties
    rows += [(1000 + i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)], i % 10) for i in range(300)]
    rows += [(0, same, 0), (0, same, 2), (100, [9.0], 1), (101, [], 1), (102, [1.0, 1.0, 1.0, 1.0], 1)]
    rows += [(2000, None, 1), (2100, same, None), (None, same, 1), (2200, [None, 1.0, 1.0], 1), (2300, [float("nan")] * 3, 1), (2400, [float("inf"), 0.0, 0.0], 1)]
    rows += [(-100, [0.5, 0.5, 0.5], 5), (4000, [0.25, 0.0, 0.0], 77)]
    rng.shuffle(rows)
    assert mined(spark, rows) == brute(rows)


def test_few_rows_and_clashing_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(0, [], 1), (1, [], 1)]) == []
    rows = [(100, [1.0, 0.0], 1), (101, [1.0, 0.5], 1), (102, [0.9, 0.0], 2)]
    wide = [(*r, "x", "y", 1, 2) for r in rows]
    assert mined(spark, wide, ROWS + ", leaf string, v string, part int, score int") == mined(spark, rows) == brute(rows)


def test_large_vectors_are_refused(spark):
    with pytest.raises(ValueError, match="too large"):
        mined(spark, [(1, [1e30], 1)])


def test_the_tree_rules_out_and_loses_nothing():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(4000, 3)))
    most = (x**2).sum(axis=1).max()
    tree = N.Tree.fit(N.augmented(x, most), 64)
    q = np.floor(256 * rng.normal(size=(50, 3)))
    least, largest = tree.bounds(np.hstack((q, np.zeros((50, 1)))))
    distance = np.sqrt((q**2).sum(axis=1)[:, None] + most - 2 * q @ x.T)
    begins = np.concatenate(([0], tree.ends[:-1]))
    for b, (begin, end) in enumerate(zip(begins, tree.ends)):
        of = distance[:, tree.order[begin:end]]
        assert (least[:, b] <= of.min(axis=1)).all() and (largest[:, b] >= of.max(axis=1)).all()
    fifth = np.sort(distance, axis=1)[:, 4]
    assert (least > fifth[:, None]).mean() > 0.3  # buckets that a search for five rows can leave out
