from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from waymark.llm import decontaminate as D
from waymark.llm.tokens import groups

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", text).lower().split()


def distance(item, run):
    """Least edits between ``item`` and any part of ``run``."""
    row = [0] * (len(run) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(run):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(docs, items):
    out = set()
    for d, text in docs:
        w = words(text or "")
        for i, t in items:
            x = words(t or "")
            if len(x) < D.LEAST_WORDS or len(set(w) & set(x)) < len(set(x)) / 2:
                continue
            if distance(x, w) <= int(D.allowed_edits(np.array([len(x)]))[0]):
                out.add((d, i))
    return out


def nearest_run(item, run):
    """(edits, first, end) of the part of ``run`` that is nearest to ``item``: the first to end, then the shortest."""

    def edits(part):
        row = list(range(len(part) + 1))
        for i, x in enumerate(item):
            new = [i + 1]
            for j, y in enumerate(part):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    return min((edits(run[a:b]), b, b - a) for b in range(len(run) + 1) for a in range(b + 1))


def edited(rng, x, k, vocabulary):
    x = list(x)
    for _ in range(k):
        at = rng.randrange(len(x))
        kind = rng.randrange(3)
        if kind == 0:
            x[at] = rng.choice(vocabulary)
        elif kind == 1:
            x.insert(at, rng.choice(vocabulary))
        elif len(x) > 1:
            del x[at]
    return x


def test_recall_against_brute_force():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(8, 60)))) for i in range(60)]
    docs = []
    for d in range(600):
        body = rng.choices(vocabulary, k=rng.randrange(0, 80))
        if d % 2:
            x = items[d % 60][1].split()
            k = int(D.allowed_edits(np.array([len(x)]))[0])
            at = rng.randrange(len(body) + 1)
            body[at:at] = edited(rng, x, rng.randrange(k + 2), vocabulary)
        docs.append((d, " ".join(body)))
    want = brute(docs, items)
    index = D.build_index(items)
    got = set()
    for at, _, texts in groups(pa.array([t for _, t in docs])):
        got |= {(at + int(r[0]), int(index.ids[r[1]])) for r in D.leaks_in(texts, index)}
    assert got <= want
    assert len(got) >= 0.99 * len(want) and len(want) > 250


def test_no_leak_of_a_long_item_is_lost():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    for size in (60, 100, 200, 400, 800):
        items = [(i, " ".join(rng.choices(vocabulary, k=size))) for i in range(12)]
        k = int(D.allowed_edits(np.array([size]))[0])
        docs = [" ".join(rng.choices(vocabulary, k=40) + edited(rng, t.split(), k, vocabulary) + ["end"]) for _, t in items]
        index = D.build_index(items)
        _, _, texts = next(groups(pa.array(docs), 1 << 30))
        assert {(int(r[0]), int(index.ids[r[1]])) for r in D.leaks_in(texts, index)} == {(i, i) for i in range(12)}


def test_recall_of_buckets_for_a_single_segment():
    """One unchanged segment, edits spread over all others: the least that the search has to go by."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    for size in (15, 40, 150):
        k = int(D.allowed_edits(np.array([size]))[0])
        items = [(i, " ".join(rng.choices(vocabulary, k=size))) for i in range(100)]
        docs = []
        for _, t in items:
            x, cuts, spared = t.split(), np.linspace(0, size, k + 2).astype(int), rng.randrange(k + 1)
            for a, b in reversed([c for j, c in enumerate(zip(cuts[:-1], cuts[1:])) if j != spared]):
                x[a:b] = edited(rng, x[a:b], 1, vocabulary)
            docs.append(" ".join(rng.choices(vocabulary, k=20) + x + rng.choices(vocabulary, k=20)))
        index = D.build_index(items)
        _, _, texts = next(groups(pa.array(docs), 1 << 30))
        assert len({(int(r[0]), int(r[1])) for r in D.leaks_in(texts, index)} & {(i, i) for i in range(100)}) >= 99, size


def test_runs_are_told_exactly():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(8, 20)))) for i in range(40)]
    docs = []
    for _, t in items:
        body = rng.choices(vocabulary, k=rng.randrange(2, 12))
        x = t.split()
        docs.append(" ".join(body[:2] + edited(rng, x, rng.randrange(int(D.allowed_edits(np.array([len(x)]))[0]) + 1), vocabulary) + body[2:]))
    index = D.build_index(items)
    _, _, texts = next(groups(pa.array(docs), 1 << 30))
    told = {int(r[0]): (int(r[2]), int(r[4]), int(r[4] - r[3])) for r in D.leaks_in(texts, index) if r[0] == index.ids[r[1]]}
    assert len(told) == 40
    for i, t in items:
        assert told[i] == nearest_run(t.split(), docs[i].split()), i


def test_one_long_item_among_short_ones():
    """The index grows with the words of the items, not with the longest of them."""
    import tracemalloc

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30_000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=20))) for i in range(10_000)] + [(10_000, " ".join(rng.choices(vocabulary, k=20_000)))]
    tracemalloc.start()
    index = D.build_index(items)
    docs = [items[7][1] + " end", "x " + items[10_000][1], "y " + " ".join(edited(rng, items[10_000][1].split(), 3000, vocabulary))]
    _, _, texts = next(groups(pa.array(docs), 1 << 30))
    got = {(int(r[0]), int(index.ids[r[1]])) for r in D.leaks_in(texts, index)}
    assert got == {(0, 7), (1, 10_000), (2, 10_000)}
    assert tracemalloc.get_traced_memory()[1] < 500_000_000
    tracemalloc.stop()


def test_planted_passages_in_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    found = D.find_leaks(docs, items).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == want and len(found) == len(got)
    kept = {r.doc_id for r in D.drop_leaks(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in got}


def test_edge_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(1, passage), (2, None), (3, "too short"), (None, passage)], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [
            (1, None, None, None, None),
            (2, "", None, None, None),
            (3, f"so: {passage.upper()}!! end", None, None, None),
            (3, f"so: {passage.upper()}!! end", None, None, None),
            (None, passage.replace("five", "5"), None, None, None),
            (5, "pad " * 400_000 + passage, None, None, None),
            (6, "too short", None, None, None),
        ],
        DOCS,
    )
    got = [(r.doc_id, r.item_id, r.edits) for r in D.find_leaks(docs, items).collect()]
    assert got == [(3, 1, 0), (3, 1, 0), (None, 1, 1), (5, 1, 0), (6, 3, 0)]
    assert [r.doc_id for r in D.drop_leaks(docs, items).collect()] == [1, 2]
    assert D.find_leaks(docs, items.limit(0)).count() == 0
    assert D.drop_leaks(docs.limit(0), items).count() == 0
    assert D.drop_leaks(docs, items.limit(0)).count() == 7


def test_short_items_and_scripts_without_blanks(spark):
    chinese = "人工智能正在改变我们学习和工作的方式，它的影响十分深远。"
    thai = "ภาษาไทยเขียนติดกันโดยไม่เว้นวรรคระหว่างคำ"
    rare = "𠮷野家で牛丼を食べた"
    items = spark.createDataFrame(
        [(1, chinese), (2, thai), (3, "to be or not to be"), (4, "one two"), (5, "水。"), (6, None), (7, ""), (8, rare)],
        "item_id bigint, text string",
    )
    docs = spark.createDataFrame(
        [
            (1, f"新闻：{chinese}完"),
            (2, "新闻" + chinese.replace("学习", "读书").replace("，", " ") + "end"),
            (3, f"x{thai}y"),
            (4, "He said: To be, or not to be!"),
            (5, "to be or never to be"),
            (6, "one two 水"),
            (7, "天气很好，我们去公园散步。Георгий écrit ภาษา"),
            (8, f"昨日{rare}。"),
        ],
        "doc_id bigint, text string",
    )
    got = {(r.doc_id, r.item_id, r.edits) for r in D.find_leaks(docs, items).collect()}
    assert got == {(1, 1, 0), (2, 1, 2), (3, 2, 0), (4, 3, 0), (8, 8, 0)}
    assert [r.doc_id for r in D.drop_leaks(docs, items).collect()] == [5, 6, 7]


def test_items_of_a_word_or_two_are_whole_documents(spark):
    items = spark.createDataFrame([(1, "Yes."), (2, "no way"), (3, "水。"), (None, "!!")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "yes"), (2, "yes no way"), (3, " No, way! "), (4, "水"), (5, "no"), (6, "?")], "doc_id bigint, text string")
    assert [tuple(r) for r in D.find_leaks(docs, items).collect()] == [(1, 1, 1, 0, 0, 1), (3, 2, 2, 0, 0, 2), (4, 3, 1, 0, 0, 1)]
    assert [r.doc_id for r in D.drop_leaks(docs, items).collect()] == [2, 5, 6]


def test_items_without_id(spark):
    one, two = ("red green blue grey pink black white brown gold silver", "a b c d e f g h i j k l")
    items = spark.createDataFrame([(1, one), (None, one), (None, two), (None, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {two} y"), (3, "x y")], "doc_id bigint, text string")
    assert [(r.doc_id, r.item_id, r.edits) for r in D.find_leaks(docs, items).collect()] == [(1, 1, 0), (2, None, 0)]
    assert [r.doc_id for r in D.drop_leaks(docs, items).collect()] == [3]


def measured(call):
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def one_group(texts):
    return next(groups(pa.array(texts), 1 << 26))[2]


def test_near_equal_items_and_repeated_words_take_bounded_memory(monkeypatch):
    """Items of one template share their buckets, and a repeated word lays a window at every place."""
    rng = random.Random(8)
    template = "Compute the sum of the numbers {} and {} and give the result as a single number without any further words"
    say = lambda: template.format(rng.randrange(1000), rng.randrange(1000))
    index = D.build_index([(k, say()) for k in range(400)])
    texts = one_group([say() for _ in range(60)] + ["nothing of the kind is said here at all"])
    rows, peak = measured(lambda: D.leaks_in(texts, index))
    assert {(t, k) for t, k, *_ in rows.tolist()} == {(t, k) for t in range(60) for k in range(400)}
    assert peak < 100 << 20
    monkeypatch.setattr(D, "CANDIDATES", 5000)
    assert (D.leaks_in(texts, index) == rows).all()  # in many slices
    some = D.leaks_in(texts, index, any_item=True)
    assert set(some[:, 0].tolist()) == set(range(60)) and len(some) < len(rows) / 2
    monkeypatch.undo()
    index = D.build_index([(1, "a " * 12)])
    rows, peak = measured(lambda: D.leaks_in(one_group(["b " + "a " * 60_000]), index))
    assert rows.tolist() == [[0, 0, 0, 1, 13]] and peak < 100 << 20
