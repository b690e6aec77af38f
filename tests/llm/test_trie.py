from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256

import pytest
from oracle import compare

from waymark.llm import trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(conversations):
    """{conv_id: [(role, text)]} to the rows of the trie."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    out = []
    for node, of in members.items():
        below = [u for u in members if u[: len(node)] == node]
        saved = sum((len(members[u]) - 1) * len(u[-1][1]) for u in below if u)
        ends = ",".join(map(str, sorted(c for c in of if len(conversations[c]) == len(node))))
        out.append(
            (min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]),
             sum(not children[u] for u in below), saved, sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def rows_of(conversations):
    return [(c, n, *turn) for c, turns in conversations.items() for n, turn in enumerate(turns)]


def trie_of(spark, rows, **kind):
    frame = spark.createDataFrame(rows, TURNS)
    return sorted(map(tuple, trie.prefix_trie(trie.as_opened(frame)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_tries_match_brute_force(spark, seed):
    rng = random.Random(seed)
    said = [("user", "a"), ("user", ""), ("", "a"), ("assistant", "aé😀"), ("u", "sera")]
    talks = {c: [said[min(rng.randrange(6), rng.randrange(5))] for _ in range(rng.randrange(1, 7))] for c in range(-20, 180)}
    assert trie_of(spark, rows_of(talks)) == brute(talks)


def test_a_deep_conversation_and_a_hot_start(spark):
    """Depth costs no rounds, and a start that all share is merged in slots."""
    deep = [("user", f"t{n}") for n in range(3000)]
    talks = {1: deep, 2: deep[:2000], **{c: [("system", "same"), ("user", str(c % 7))] for c in range(3, 2000)}}
    got = trie_of(spark, rows_of(talks))
    assert len(got) == 1 + 3000 + 1 + 7
    root = next(r for r in got if r[1] == 0)
    assert root[:6] == (1, 0, None, 1999, 2, 8)
    assert root[6] == sum(len(t) for _, t in deep[:2000]) + 1996 * 4 + (1997 - 7)
    starts = next(r for r in got if r[0] == 3 and r[1] == 1)
    assert starts[3:6] == (1997, 7, 7)


def test_odd_rows_match_sql(spark, tmp_path):
    rows = [
        (1, 0, "user", None), (1, 1, None, "no role"), (1, None, "system", "first"), (1, 2, "a", "x"), (1, 2, "a", "x"), (1, 2, "a", "b"),
        (0, 0, "user", "head"), (0, 1, "assistant", "second"), (0, None, None, None), (7, 5, "user", "late"), (7, -1, "user", "early"),
        (-1, 0, "user", "x"), (-100, 3, "user", "own"), (-163, 0, "user", "z"), (None, 0, "user", "nobody"), (None, None, None, None),
        (512, 0, "u", "only"), (577, 0, "u", "only"), (599, 0, "u", "t" * 100_000), (9_000_000_000, 0, "user", "far"),
    ]
    rows += [(c, t, "user", f"{t % 3}") for c in range(1000, 1230) for t in range(c % 9)]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    sql = trie.OP12_SQL.replace("FROM conversations", f"FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet') AS conversations")
    assert compare(spark, "op12", trie.op12_prefix_trie, sql, str(tmp_path)) > 40


def test_an_empty_table_and_clashing_columns(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(trie.with_shared_heads(none)).count() == 0
    more = spark.createDataFrame([(1, 0, "a", "b", 3, "x", 4)], TURNS + ", k1 int, skip string, part int")
    got = [tuple(r)[:6] for r in trie.prefix_trie(trie.with_shared_heads(more)).orderBy("depth").collect()]
    assert got == [(1, 0, None, 1, 1, 1), (1, 1, 1, 1, 0, 1)] or got == [(1, 0, None, 1, 0, 1)]


def test_end_lists_travel_in_runs(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN_CHARS", 50)
    talks = {c: [("user", "a")] for c in range(-500, 500)} | {1000: [("user", "b")]}
    assert trie_of(spark, rows_of(talks)) == brute(talks)
