"""Near-duplicate removal by min-max hashing.

A document is the set of its distinct word shingles. Under each permutation both the
minimum and the maximum of the set are kept, so P hash evaluations give a signature of
2P values whose share of agreements estimates the Jaccard similarity without bias. Bands
of ROWS values each deal documents to buckets. Candidates are confirmed on the full sets:

1. Documents with equal sets form a class; its node is its least doc_id.
2. In each bucket all nodes are linked to the least one, the bucket's hub. These candidate links are confirmed,
   and the components of the confirmed ones taken.
3. Links may be missing in a bucket between nodes that aren't its hub. So where the others
   of a bucket lie in several components, they are dealt to blocks of bounded size, and
   pairs of blocks are compared set by set, except blocks inside one component. Buckets of the
   same nodes are compared once. Only links that join components come out.

So no link between candidates is lost, no pairs of a group are emitted, copies
cost what their class costs, and a text shared by many documents makes no group larger than a bucket.

Defined results:
- null or empty text, or only blanks: no shingles, linked with nothing;
- rows with a null doc_id are linked with nothing: component null, kept;
- repeated rows are one document: each row comes back with the same component, and costs one set;
- rows of one doc_id with different texts each go by their text; texts whose least doc_id is the same share their links;
- an empty table gives no rows; further input columns are ignored, and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import checked_broadcast, cut, free_name, table
from .graph import components
from .tokens import U64, finalize, fold, groups, shingle_sets, words_of

#: Values in a band, and the chance that no band finds a pair just at the threshold.
#: At a similarity of 0.85 a band of eight agrees with probability 0.27, at 0.5 with 0.004.
ROWS = 8
MISS = 1e-6
#: A block holds about so many nodes, and about so many shingles.
BLOCK_NODES = 128
BLOCK_SHINGLES = 400_000
#: Shingles that are permuted at once.
CHUNK = 512
#: Columns of shingles compared at once.
STRIPE = 4096


def permutations_for(percent: int) -> int:
    """Permutations whose minima and maxima fill enough bands for the threshold."""
    bands = log(MISS) / log(1 - (percent / 100) ** ROWS)
    return ROWS * ceil(bands / 2)  # so minima fill whole bands, and maxima too


U32 = np.uint32


class MinMax:
    """Permutations of the upper 32 bits of shingle hashes; exact confirmation follows, so that width does."""

    def __init__(self, permutations: int, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 1 << 31, (permutations, 1), dtype=U32) * U32(2) + U32(1)
        self.flip = rng.integers(0, 1 << 32, (permutations, 1), dtype=U32)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Minima, then maxima, under each permutation of a set that isn't empty."""
        low, high = None, None
        short = (shingles >> U64(32)).astype(U32)
        for at in range(0, len(short), CHUNK):
            value = short[at : at + CHUNK] ^ self.flip
            value *= self.factor
            least, most = value.min(axis=1), value.max(axis=1)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        return np.concatenate((low, high))

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        rows = self.signature(shingles).reshape(-1, ROWS).astype(U64)
        return finalize(fold([rows[:, j] for j in range(ROWS)]) + np.arange(len(rows), dtype=U64))


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity that two signatures tell."""
    return float((a == b).mean())


def class_of(shingles: np.ndarray) -> bytes:
    """128 bits that name the set."""
    return b"".join(
        finalize(np.array([np.bitwise_xor.reduce(finalize(shingles + U64(s))), shingles.sum() + U64(s)], U64)).tobytes()
        for s in (1, 2)
    )


def signer(size: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinMax(permutations_for(percent))
        for batch in batches:
            for at, to, texts in groups(batch.column("text")):
                sets = shingle_sets(words_of(texts), size)
                columns = [
                    batch.column("doc_id")[at:to].cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([hashing.bands(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "class", "bands"])

    return run


def setter(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in groups(batch.column("text")):
                sets = shingle_sets(words_of(texts), size)
                arrays = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                classes = pa.array([class_of(s) if len(s) else None for s in sets], pa.binary())
                ids = batch.column("doc_id")[at:to].cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, classes, arrays], ["node", "class", "shingles"])

    return run


def comparer(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Compare the nodes of two blocks; a spanning forest of the links between components comes out."""

    def run(group: pa.Table) -> pa.Table:
        node, root = group["node"].to_numpy(), group["root"].to_numpy()
        side = group["side"].to_numpy()
        sets = group["shingles"].combine_chunks()
        if isinstance(sets, pa.ChunkedArray):
            sets = sets.chunk(0)
        length = np.diff(sets.offsets.to_numpy())
        flat = sets.flatten().to_numpy()
        of = np.repeat(np.arange(len(node)), length)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(right):  # a block with itself
            right = left
        local = np.full(len(node), -1)
        local[left] = np.arange(len(left))
        other = np.full(len(node), -1)
        other[right] = np.arange(len(right))
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1  # a shingle of one set alone joins nothing
        renumber = np.cumsum(shared) - 1
        keep = shared[column]
        column, of = renumber[column[keep]], of[keep]
        order = np.argsort(column, kind="stable")
        column, of = column[order], of[order]
        both = np.zeros((len(left), len(right)), np.float32)
        n_columns = int(shared.sum())
        cuts = np.searchsorted(column, np.arange(0, n_columns + STRIPE, STRIPE))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            marks = []
            for numbers, rows in ((local, len(left)), (other, len(right))):
                mine = numbers[of[a:b]] >= 0
                mark = np.zeros((rows, STRIPE), np.float32)
                mark[numbers[of[a:b]][mine], column[a:b][mine] - k * STRIPE] = 1
                marks.append(mark)
            both += marks[0] @ marks[1].T
        common = both.astype(np.int64)
        union = length[left][:, None] + length[right][None, :] - common
        hit = (100 * common >= percent * union) & (root[left][:, None] != root[right][None, :])
        parent = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        a_out, b_out = [], []
        for i, j in np.argwhere(hit).tolist():
            x, y = find(int(root[left[i]])), find(int(root[right[j]]))
            if x != y:
                parent[x] = y
                a_out.append(int(root[left[i]]))
                b_out.append(int(root[right[j]]))
        return pa.table({"a": pa.array(a_out, pa.int64()), "b": pa.array(b_out, pa.int64())})

    return run


def confirm(links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) that hold on the full sets. A node with many links had best be a: its set is sent once, theirs once each."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return links.join(two, "b").join(one, "a").where(100 * common >= percent * union).select("a", "b")


def with_roots(spokes: DataFrame, found: DataFrame) -> DataFrame:
    """The spokes with root, the component of the node so far."""
    return spokes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def open_members(spokes: DataFrame, found: DataFrame, flag: str | None = None) -> DataFrame:
    """The spokes (with root, and many, their number) of buckets whose nodes lie in several components; of buckets of the same
    nodes one. flag: a column that must hold for one of the nodes, and that tells nodes apart."""
    h = F.xxhash64("node", flag) if flag else F.xxhash64("node")
    buckets = cut(
        with_roots(spokes, found)
        .groupBy("band")
        .agg(
            F.min("root").alias("lo"),
            F.max("root").alias("hi"),
            F.max(flag if flag else F.lit(True)).alias("flagged"),
            F.count("*").alias("many"),
            F.bit_xor(h).alias("mix"),
            F.sum(h % (1 << 31)).alias("total"),
        )
        .where("lo != hi AND flagged")
        .groupBy("many", "mix", "total")
        .agg(F.min("band").alias("band")),
        "open",
    )
    return cut(with_roots(spokes.join(buckets.select("band", "many"), "band"), found), "members")


def compare_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that meet in a bucket.

    members: band, node, root (its component so far), n. A component of half a block or more has
    blocks of its own; the others of a bucket share blocks. Nodes are parted by the size of their sets, in steps such that sets two steps
    apart can't be similar enough, and dealt by hash. The tables of blocks
    are small, and written, so that a join with a large bucket can be split.
    """
    ratio = log(100 / percent) * (1 + 1e-9) + 1e-9  # a little more, so that rounding parts no pair
    members = members.select("band", "node", "root", "n", F.floor(F.log("n") / ratio).cast("int").alias("step"))
    sizes = members.groupBy("band", "root", "step").agg(F.count("*").alias("m"), F.sum("n").alias("shingles"))
    own = (F.col("m") >= BLOCK_NODES // 2) | (F.col("shingles") >= BLOCK_SHINGLES // 2)
    pools = cut(sizes.withColumn("pool", F.when(own, F.col("root")).otherwise(-1)), "pools")  # -1: the shared pool
    blocks = pools.groupBy("band", "step", "pool").agg(
        F.greatest(
            F.ceil(F.sum("m") / BLOCK_NODES), F.ceil(F.sum("shingles") / BLOCK_SHINGLES), F.lit(1).cast("bigint")
        ).alias("n_blocks")
    )
    pools = cut(pools.join(blocks, ["band", "step", "pool"]).select("band", "root", "step", "pool", "n_blocks"), "blocks")
    block = F.struct("step", "pool", F.pmod(F.xxhash64("node"), F.col("n_blocks")).alias("part")).alias("block")
    dealt = cut(members.join(pools, ["band", "root", "step"]).select("band", "node", "root", block), "dealt")
    listed = cut(dealt.select("band", "block").distinct(), "listed")
    reach = listed.withColumn("meets", F.explode(F.array("block.step", F.col("block.step") + 1)))
    others = listed.select("band", F.col("block").alias("other"), F.col("block.step").alias("meets"))
    pairs = cut(
        reach.join(others, ["band", "meets"])
        .where("block <= other AND (block.pool != other.pool OR block.pool = -1)")
        .select("band", "block", "other", F.struct("band", "block", "other").alias("pair")),
        "pairs",
    )
    left = dealt.join(pairs.select("band", "block", "pair"), ["band", "block"]).withColumn("side", F.lit(0))
    right = (
        dealt.withColumnRenamed("block", "other")
        .join(pairs.where("block != other").select("band", "other", "pair"), ["band", "other"])
        .withColumn("side", F.lit(1))
    )
    columns = ["pair", "side", "node", "root"]
    sides = left.select(columns).union(right.select(columns)).join(sets.select("node", "shingles"), "node")
    return sides.select(*columns, "shingles").groupBy("pair").applyInArrow(comparer(percent), "a bigint, b bigint")


def sets_of(docs: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """node, shingles of the documents among ``nodes``: one row for each text of a node, however often its row is repeated."""
    wanted = checked_broadcast(nodes.select(F.col("node").alias("doc_id")))
    rows = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    sets = rows.mapInArrow(setter(size), "node bigint, class binary, shingles array<bigint>").where("class IS NOT NULL")
    repeated = cut(
        signed.groupBy(F.col("doc_id").alias("node")).count().where("count > 1 AND node IS NOT NULL").select("node"), "twice"
    )
    if not repeated.isEmpty():
        twice = checked_broadcast(repeated)
        once = sets.join(twice, "node", "left_semi").dropDuplicates(["node", "class"])
        sets = sets.join(twice, "node", "left_anti").unionByName(once)
    return cut(sets.select("node", "shingles"), "sets")


def labelled(signed: DataFrame, classes: DataFrame, found: DataFrame, joined: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class, component_id, kept of every signed row.

    found: components of nodes; joined: components of links between roots of those and nodes that have none.
    """
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("top"))
    tops = found.join(joined, "root", "left").select("node", F.coalesce("top", "root").alias("top"))
    alone = joined.join(found, joined.root == found.node, "left_anti").select(F.col("root").alias("node"), "top")
    tops = cut(tops.unionByName(alone), "tops")
    named = classes.select("class", "node").join(tops, "node", "left").select("class", F.coalesce("top", "node").alias("top"))
    return (
        signed.select("doc_id", F.col("n").alias("n_shingles"), "class")
        .join(named, "class", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("top", "doc_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .drop("top")
    )


def link(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, class, component_id, kept of every row of ``docs``."""
    signed = cut(
        docs.select("doc_id", "text").mapInArrow(
            signer(size, percent), "doc_id bigint, n bigint, class binary, bands array<bigint>"
        ),
        "signed",
    )
    classes = cut(
        signed.where("doc_id IS NOT NULL AND class IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    banded = classes.select("node", "n", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.count("*").alias("many"), F.min("node").alias("hub")).where("many > 1")
    spokes = cut(
        banded.join(hubs.select("band", "hub"), "band").where("node != hub").select("band", "hub", "node", "n"), "spokes"
    )
    stars = cut(spokes.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    nodes = cut(stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct(), "nodes")
    sets = sets_of(docs, signed, nodes, size)
    found = components(confirm(stars, sets, percent))
    joined = components(compare_blocks(open_members(spokes, found), sets, percent))
    return labelled(signed, classes, found, joined)


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, repeated rows once."""
    linked = cut(link(docs, size, percent), "linked")
    gone = cut(linked.where("NOT kept").select("doc_id").distinct(), "gone")
    stay = docs.join(checked_broadcast(gone), "doc_id", "left_anti").select(docs.columns)
    repeated = cut(
        linked.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated"
    )
    if repeated.isEmpty():
        return stay
    marked = checked_broadcast(repeated)
    again = stay.join(marked, "doc_id", "left_semi").select(docs.columns)
    by = W.partitionBy("doc_id", "text").orderBy(*[F.col(c) for c, kind in docs.dtypes if not kind.startswith("map")])
    nth = free_name(again, "nth")
    once = again.withColumn(nth, F.row_number().over(by)).where(F.col(nth) == 1).drop(nth)
    return stay.join(marked, "doc_id", "left_anti").select(docs.columns).unionByName(once)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id", "kept")
