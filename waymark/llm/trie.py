"""Conversation prefix trie by mergeable partial tries.

A node is a sequence of first turns (role, text); the root has none. A node's key is a chain of 128-bit hashes, so that
each row of a conversation names its node by itself:

1. Paths: the turns of a conversation, in order, run through the chain. State is one hash, so memory doesn't follow the
   conversation; its rows are read by one task.
2. Partial tries: every task combines its paths to one row for a node (members, least member), and tables of nodes are
   merged by key, first in slots, then whole, so that a node which all conversations share is no hot key.
3. End lists: ids that end at a node are ordered over all tasks, joined to runs of text, and the runs of a node are fed to
   one digest in order, without ever being held together.
4. Rollup: each node belongs to its least member, whose nodes are the end of its path, so every conversation knows what it
   adds to a subtree: the childless node that it owns, and the part of its path that others own. These are summed
   bottom-up, from the ends of paths to the root, by the same merges. Depth costs no rounds.

Defined results:
- null roles and texts are empty; rows with a null conv_id belong to no conversation and take no part;
- null turns come first; rows of one turn are ordered by role, then text, and repeated rows are turns of their own;
- c - c % 100 has the sign of c's remainder as in SQL, so the head of conversation -1 is conversation 0;
- a conversation without turns is a member of the root and ends there; an empty table gives no rows;
- further input columns are ignored; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, table

#: Conversations share heads of fewer turns than this.
HEADS = 6
#: Slots of the merges of node tables, one round each.
MERGES = (64, 1)
#: Characters of a run of ids.
RUN_CHARS = 1 << 15
#: Rows in an Arrow batch that is handed back.
BATCH = 20_000

PATHS = "conv_id bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, depth bigint, before bigint, after bigint, last boolean"
KEY = ["k1", "k2"]
ROOT = bytes(16)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, nulls of role and text empty, without rows of no conversation."""
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def with_shared_heads(conversations: DataFrame) -> DataFrame:
    """Every conversation rebuilt: the first h turns of the first one of its hundred, then its own after its first h.

    Rows: conv_id, part (0: one row that opens the conversation, 1: turns of the head, 2: all own turns), turn, role, text,
    skip (own turns to leave out).
    """
    rows = turns_of(conversations)
    opened = rows.select("conv_id").distinct().withColumn("skip", head_length(F.col("conv_id")))
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    heads = rows.where("conv_id % 100 = 0").withColumn("nth", F.row_number().over(order)).where(F.col("nth") < HEADS)
    heads = heads.withColumnRenamed("conv_id", "base")
    taken = opened.withColumn("base", F.expr("conv_id - conv_id % 100")).join(heads, "base").where("nth <= skip")
    columns = ["conv_id", "part", "turn", "role", "text", "skip"]
    return (
        opened.selectExpr("conv_id", "0 AS part", "cast(null AS bigint) AS turn", "'' AS role", "'' AS text", "skip")
        .unionByName(taken.withColumn("part", F.lit(1)).select(columns))
        .unionByName(rows.withColumn("part", F.lit(2)).withColumn("skip", head_length(F.col("conv_id"))).select(columns))
    )


def as_opened(conversations: DataFrame) -> DataFrame:
    """Conversations as they are, in the form of ``with_shared_heads``."""
    rows = turns_of(conversations)
    opened = rows.select("conv_id").distinct()
    return opened.selectExpr(
        "conv_id", "0 AS part", "cast(null AS bigint) AS turn", "'' AS role", "'' AS text", "0L AS skip"
    ).unionByName(rows.selectExpr("conv_id", "2 AS part", "turn", "role", "text", "0L AS skip"))


def step(key: bytes, role: str, text: str) -> bytes:
    """The key of a node's child."""
    said = role.encode()
    return blake2b(key + len(said).to_bytes(8, "little") + said + text.encode(), digest_size=16).digest()


def halves(key: bytes) -> tuple[int, int]:
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


def emit(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of conversations and turns to nodes on paths.

    before and after: code points of the turns ahead of the node's last one, and with it.
    """
    names = ["conv_id", "k1", "k2", "p1", "p2", "depth", "before", "after", "last"]
    types = [pa.int64()] * 8 + [pa.bool_()]
    out: list[tuple] = []
    here: tuple | None = None  # the node reached, not yet handed back
    key, own = ROOT, 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "part", "role", "text", "skip")]
        for conv, part, role, text, skip in zip(*columns):
            if part == 0:
                if here is not None:
                    out.append((*here, True))
                key, own = ROOT, 0
                here = (conv, *halves(ROOT), None, None, 0, 0, 0)
            else:
                own += part == 2
                if part == 2 and own <= skip:
                    continue
                out.append((*here, False))
                parent, key = key, step(key, role, text)
                here = (conv, *halves(key), *halves(parent), here[5] + 1, here[7], here[7] + len(text))
            if len(out) >= BATCH:
                yield emit(out, names, types)
                out = []
    if here is not None:
        out.append((*here, True))
    if out:
        yield emit(out, names, types)


def paths_of(opened: DataFrame) -> DataFrame:
    """A row for every conversation and node on its path, the root too."""
    ordered = opened.repartition("conv_id").sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(walk, PATHS)


def merged(paths: DataFrame, slot: Column, **sums: tuple[Column, Column]) -> DataFrame:
    """Tables of nodes merged by key, in slots and then whole. sums: name=(aggregate of rows, aggregate of those)."""
    now = paths.withColumn("slot", F.pmod(F.xxhash64(slot), F.lit(MERGES[0])))
    for nth, slots in enumerate(MERGES):
        by = [*KEY, F.pmod("slot", F.lit(slots)).alias("slot")]
        now = now.groupBy(*by).agg(*[(again if nth else first).alias(name) for name, (first, again) in sums.items()])
    return now.drop("slot")


def node_table(paths: DataFrame) -> DataFrame:
    """k1, k2, p1, p2, depth, before, conv_id (least member) and n_convs of each node."""
    same = {c: (F.min(c), F.min(c)) for c in ("p1", "p2", "depth", "before", "conv_id")}  # all rows of a node agree but on conv_id
    return merged(paths, F.col("conv_id"), **same, n_convs=(F.count("*"), F.sum("n_convs")))


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, conv_id) to runs (k1, k2, first, ids), ids comma-joined."""
    names, types = ["k1", "k2", "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    out: list[tuple] = []
    now, first, ids, chars = None, 0, [], 0
    for batch in batches:
        for k1, k2, conv in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "conv_id"))):
            if (k1, k2) != now or chars > RUN_CHARS:
                if ids:
                    out.append((*now, first, ",".join(ids)))
                now, first, ids, chars = (k1, k2), conv, [], 0
                if len(out) >= 1000:
                    yield emit(out, names, types)
                    out = []
            ids.append(str(conv))
            chars += len(ids[-1]) + 1
    if ids:
        out.append((*now, first, ",".join(ids)))
    if out:
        yield emit(out, names, types)


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs to (k1, k2, ends_sha256): the runs of a node follow each other through one digest."""
    names, types = ["k1", "k2", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()]
    out: list[tuple] = []
    now, state = None, None
    for batch in batches:
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) == now:
                state.update(b",")
            else:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (k1, k2), sha256()
            state.update(ids.encode())
            if len(out) >= BATCH:
                yield emit(out, names, types)
                out = []
    if now is not None:
        out.append((*now, state.hexdigest()))
    if out:
        yield emit(out, names, types)


def end_lists(paths: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256 of the nodes at which conversations end."""
    ids = paths.where("last").select(*KEY, "conv_id")
    runs = ids.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    runs = runs.mapInArrow(pack, "k1 bigint, k2 bigint, first bigint, ids string")
    return (
        runs.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, "k1 bigint, k2 bigint, ends_sha256 string")
    )


def roll_up(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """k1, k2, n_leaves and saved_tokens of each node's subtree. nodes: with n_children."""
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("kept"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    whole = paths.where("last").select("conv_id", "after")
    adds = whole.join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("kept", "after").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf")
    )
    saved = F.greatest(F.col("shared") - F.col("before"), F.lit(0))
    return merged(
        paths.select(*KEY, "conv_id", "before").join(adds, "conv_id"),
        F.col("conv_id"),
        n_leaves=(F.sum("leaf"), F.sum("n_leaves")),
        saved_tokens=(F.sum(saved), F.sum("saved_tokens")),
    )


def prefix_trie(opened: DataFrame) -> DataFrame:
    """The trie of conversations as ``with_shared_heads`` or ``as_opened`` give them, a row for each node."""
    paths = cut(paths_of(opened), "paths")
    table_of = node_table(paths)
    children = table_of.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children"))
    children = children.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    nodes = cut(table_of.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(sha256(b"").hexdigest())
    return (
        nodes.join(roll_up(paths, nodes), KEY)
        .join(end_lists(paths), KEY, "left")
        .join(above, ["p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(table(spark, sf_dir, "conversations")))


OP12_SQL = r"""
WITH heads AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT c, 0 AS part, pos, role, text FROM heads JOIN numbered ON conv_id = base AND pos <= h
  UNION ALL SELECT c, 1, pos, role, text FROM heads JOIN numbered ON conv_id = c AND pos > h),
turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM rebuilt),
paths AS (
  SELECT c, 0 AS d, 0 AS chars, '' AS k, NULL AS parent FROM heads
  UNION ALL
  SELECT c, d, chars, sha256(said), CASE WHEN d = 1 THEN '' ELSE sha256(lag(said) OVER (PARTITION BY c ORDER BY d)) END
  FROM (SELECT c, d, length(text) AS chars, string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
          OVER (PARTITION BY c ORDER BY d) AS said FROM turns)),
nodes AS (
  SELECT k, any_value(parent) AS parent, any_value(d) AS d, any_value(chars) AS chars, min(c) AS c, count(*) AS n
  FROM paths GROUP BY k),
children AS (SELECT parent AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent),
subtree AS (
  SELECT p.k, count(*) FILTER (x.n IS NULL) AS n_leaves, sum((u.n - 1) * u.chars) AS saved
  FROM nodes u JOIN paths p ON p.c = u.c AND p.d <= u.d LEFT JOIN children x ON x.k = u.k GROUP BY p.k),
ends AS (
  SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(k, d) AS k FROM paths GROUP BY c) GROUP BY k)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, a.c AS parent_conv_id, v.n AS n_convs,
  coalesce(x.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes v LEFT JOIN nodes a ON a.k = v.parent LEFT JOIN children x ON x.k = v.k
  JOIN subtree s ON s.k = v.k LEFT JOIN ends e ON e.k = v.k
"""
