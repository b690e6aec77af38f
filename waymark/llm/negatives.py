"""Hard negatives by a vantage-point tree over norm-augmented vectors.

A vector x gets one more component, sqrt(M - |x|^2), M the largest squared norm, and an anchor q a zero. Then
distance^2 = |q|^2 + M - 2 q.x, so the best scores are the nearest rows, and a window of scores is an annulus around q.

- Trunk: a small tree fitted on a bounded sample (about SAMPLE rows, drawn by hash) deals all rows to leaves; large leaves are dealt to parts by a
  hash of the id, so a leaf of copies grows in parts, not in size.
- Branches: each part is one row of a table: its vectors in tree order, the vantage points, and for each bucket of rows the
  range of its distances from every vantage point on its way.
- Search: anchors go in blocks, each to the parts that the trunk can't rule out. There each anchor takes its buckets nearest first
  inside its annulus, and ends when it has k rows and the next bucket is farther than the k-th, or outside. The best k of
  all parts are the answer. Positives are sought in the anchor's own leaf first; what is found there bounds the search elsewhere.

Distances only rule out buckets, with room for rounding; rows are told by integer scores, so the result is exact.

Defined results:
- rows with a null id take no part, as rows with a null label, a null vector or a null or non-finite component don't;
- shorter vectors count as if zeros followed, an empty one as zeros;
- rows of one id are one row: the least by label, then vector;
- scores are exact below 2^53, as sums of products too; a table with larger components is refused;
- equal scores are ordered by id; an anchor without positives, or a positive without negatives, gives no rows;
- an empty table gives no rows; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import checked_broadcast, cut, table

#: The trunk is fitted on about so many rows at most, and has at most so many leaves.
SAMPLE = 16_384
LEAVES = 256
#: A part holds about so many rows, a bucket at most so many.
PART = 4096
BUCKET = 128
#: Anchors in a block.
BLOCK = 256
#: Positives of an anchor, and negatives of a positive.
POSITIVES = 5
NEGATIVES = 5
#: Distances are trusted to this share, of themselves and of the largest norm.
ROOM = 1e-6
#: Scores below this are exact as doubles.
EXACT = 1 << 53


def valid_rows(embeddings: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, v (floor(256 * x)) of the rows that take part, one for each id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("double")).alias("v"),
    )
    repeated = cut(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "repeated")
    if repeated.isEmpty():
        return rows
    marked = checked_broadcast(repeated)
    least = rows.join(marked, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"))
    once = least.select("vec_id", "row.label", "row.v")
    return rows.join(marked, "vec_id", "left_anti").unionByName(once)


def augmented(v: np.ndarray, most: float) -> np.ndarray:
    """Rows with the component that makes all norms sqrt(most)."""
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", v, v), 0))
    return np.hstack((v, rest[:, None]))


def between(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - point) ** 2).sum(axis=1), 0))


class Tree:
    """A vantage-point tree: ``order`` lists rows bucket by bucket, ``ends`` bounds buckets; ``points`` are the vantage points,
    and low and high (buckets x points) the range of a bucket's distances from them, (0, inf) off its way."""

    def __init__(self, points: np.ndarray, low: np.ndarray, high: np.ndarray, order: np.ndarray, ends: np.ndarray):
        self.points, self.low, self.high, self.order, self.ends = points, low, high, order, ends

    @classmethod
    def fit(cls, x: np.ndarray, size: int) -> Tree:
        """Halve the rows by their distance from a vantage point until ``size`` are left. Equal rows fall to both sides."""
        points, ranges, order, ends = [], [], [], []

        def grow(rows: np.ndarray, way: list[tuple[int, float, float]]) -> None:
            if len(rows) <= size:
                ranges.append(way)
                order.append(rows)
                ends.append(len(rows))
                return
            tried = x[rows[:: max(1, len(rows) // 8)][:8]]  # the candidate whose distances vary most
            at = tried[int(np.argmax([between(x[rows], p).var() for p in tried]))]
            d = between(x[rows], at)
            by = np.argsort(d, kind="stable")
            rows, d, half = rows[by], d[by], len(rows) // 2
            points.append(at)
            n = len(points) - 1
            grow(rows[:half], [*way, (n, d[0], d[half - 1])])
            grow(rows[half:], [*way, (n, d[half], d[-1])])

        grow(np.arange(len(x)), [])
        low, high = np.zeros((len(ranges), len(points))), np.full((len(ranges), len(points)), np.inf)
        for b, way in enumerate(ranges):
            for n, least, most in way:
                low[b, n], high[b, n] = max(low[b, n], least), min(high[b, n], most)
        return cls(np.array(points).reshape(-1, x.shape[1]), low, high, np.concatenate(order), np.cumsum(ends))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible distance (queries x buckets) of augmented queries, with room for rounding."""
        least, most = np.zeros((len(q), len(self.ends))), np.full((len(q), len(self.ends)), np.inf)
        for n, point in enumerate(self.points):
            d = between(q, point)[:, None]
            np.maximum(least, np.maximum(self.low[None, :, n] - d, d - self.high[None, :, n]), out=least)
            np.minimum(most, self.high[None, :, n] + d, out=most)
        room = ROOM * np.sqrt(np.einsum("ij,ij->i", q, q) + 1)[:, None]
        return least * (1 - ROOM) - room, most * (1 + ROOM) + room

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The bucket for each row: the one whose ranges it violates least."""
        worst = np.zeros((len(x), len(self.ends)))
        for n, point in enumerate(self.points):
            d = between(x, point)[:, None]
            np.maximum(worst, np.maximum(self.low[None, :, n] - d, d - self.high[None, :, n]), out=worst)
        return worst.argmin(axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, zeros behind the shorter ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy().astype(np.int64)
    length = np.diff(ends)
    out = np.zeros((len(column), width))
    at = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], length)
    out[np.repeat(np.arange(len(column)), length), at] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def packed(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def router(trunk: Tree, width: int, most: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = trunk.leaf_of(augmented(matrix(batch.column("v"), width), most))
            columns = [batch.column(c) for c in ("vec_id", "label", "v")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(leaf, pa.int32())], ["vec_id", "label", "v", "leaf"])

    return run


BRANCH = "leaf int, part int, ids binary, labels binary, vectors binary, points binary, low binary, high binary, ends binary"


def grower(width: int, most: float) -> Callable[[pa.Table], pa.Table]:
    """A part's rows to one row that holds its tree."""

    def run(group: pa.Table) -> pa.Table:
        v = matrix(group["v"], width)
        tree = Tree.fit(augmented(v, most), BUCKET)
        at = tree.order
        ids, labels = group["vec_id"].to_numpy()[at], group["label"].to_numpy()[at]
        values = [ids, labels, v[at], tree.points, tree.low, tree.high, tree.ends.astype(np.int64)]
        names = ["ids", "labels", "vectors", "points", "low", "high", "ends"]
        columns = {"leaf": group["leaf"].slice(0, 1), "part": group["part"].slice(0, 1)}
        return pa.table(columns | {n: pa.array([packed(x)], pa.binary()) for n, x in zip(names, values)})

    return run


def unpacked(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Tree]:
    ids, labels, ends = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "ends"))
    points = np.frombuffer(row["points"]).reshape(-1, width + 1)
    low, high = (np.frombuffer(row[c]).reshape(len(ends), len(points)) for c in ("low", "high"))
    tree = Tree(points, low, high, np.arange(len(ids)), ends)
    return ids, labels, np.frombuffer(row["vectors"]).reshape(len(ids), width), tree


class Windows:
    """Anchors with their windows of scores, as radii around them: (inner, outer), with room for rounding."""

    def __init__(self, row: dict, width: int, most: float):
        self.ids, self.labels, self.floor, self.top = (np.frombuffer(row[c], np.int64) for c in ("anchors", "own", "floor", "top"))
        self.q = np.frombuffer(row["q"]).reshape(len(self.ids), width)
        self.norm = np.einsum("ij,ij->i", self.q, self.q) + most
        self.room = ROOM * np.sqrt(self.norm + 1)
        self.every = np.arange(len(self.ids))
        self.inner = self.radius(self.every, self.top) * (1 - ROOM) - self.room
        self.outer = self.radius(self.every, self.floor) * (1 + ROOM) + self.room

    def radius(self, of: np.ndarray, score: np.ndarray) -> np.ndarray:
        norm = self.norm[of]
        return np.sqrt(np.maximum(norm - 2 * np.clip(score.astype(np.float64), -norm, norm), 0))

    def near(self, tree: Tree) -> np.ndarray:
        """The least distance (windows x buckets) at which a bucket may have rows of the annulus; inf if it has none."""
        least, largest = tree.bounds(np.hstack((self.q, np.zeros((len(self.q), 1)))))
        near = np.maximum(least, self.inner[:, None])
        near[(largest < self.inner[:, None]) | (least > self.outer[:, None])] = np.inf
        return near


BLOCK_FIELDS = ["anchors", "own", "q", "floor", "top"]
BLOCK_TYPE = "block bigint, " + ", ".join(f"{c} binary" for c in BLOCK_FIELDS) + ", leaves array<int>"


def packer(trunk: Tree, width: int, most: float, away: bool) -> Callable[[pa.Table], pa.Table]:
    """A block's anchors to one row, with the leaves that it must look at; away: but for its own."""

    def run(group: pa.Table) -> pa.Table:
        row = {c: packed(group[n].to_numpy()) for c, n in (("anchors", "vec_id"), ("own", "label"), ("floor", "floor"), ("top", "top"))}
        row["q"] = packed(matrix(group["v"], width))
        needed = np.isfinite(Windows(row, width, most).near(trunk)).any(axis=0)
        if away:
            needed[group["leaf"][0].as_py()] = False
        leaves = pa.array([np.flatnonzero(needed)], pa.list_(pa.int32()))
        fields = {c: pa.array([row[c]], pa.binary()) for c in BLOCK_FIELDS}
        return pa.table({"block": group["block"].slice(0, 1)} | fields | {"leaves": leaves})

    return run


def searcher(width: int, most: float, same: bool, k: int) -> Callable[[pa.Table], pa.Table]:
    """A block against a part: the best k rows of each window, of the anchor's label (and another id) or of other labels."""

    def run(group: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        ids, labels, v, tree = unpacked(row, width)
        w = Windows(row, width, most)
        near = w.near(tree)
        turn = near.argsort(axis=1, kind="stable")
        best_score = np.full((len(w.ids), k), -np.inf)
        best_id = np.full((len(w.ids), k), np.iinfo(np.int64).max)
        begins = np.concatenate(([0], tree.ends[:-1]))
        active = w.every
        for nth in range(len(tree.ends)):  # each active window's nth nearest bucket
            bucket, worst = turn[active, nth], best_score[active, -1]
            told = w.radius(active, np.where(np.isfinite(worst), worst, 0)) * (1 + ROOM) + w.room[active]
            reach = np.where(np.isfinite(worst), told, w.outer[active])
            on = near[active, bucket] <= reach
            active, bucket = active[on], bucket[on]
            if not len(active):
                break
            for b in np.unique(bucket):
                asked, here = active[bucket == b], slice(begins[b], tree.ends[b])
                score = w.q[asked] @ v[here].T
                fit = (labels[None, here] == w.labels[asked, None]) == same
                if same:
                    fit &= ids[None, here] != w.ids[asked, None]
                fit &= (score >= w.floor[asked, None]) & (score <= w.top[asked, None])
                score = np.hstack((best_score[asked], np.where(fit, score, -np.inf)))
                who = np.hstack((best_id[asked], np.broadcast_to(ids[None, here], fit.shape)))
                first = np.lexsort((who, -score), axis=1)[:, :k]
                best_score[asked] = np.take_along_axis(score, first, axis=1)
                best_id[asked] = np.take_along_axis(who, first, axis=1)
        at, place = np.nonzero(np.isfinite(best_score))
        columns = [w.ids[at], w.top[at], best_id[at, place], best_score[at, place].astype(np.int64)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "top", "vec_id", "score"])

    return run


class Index:
    """All rows of a table (vec_id, label, v) under a trunk and branches."""

    def __init__(self, rows: DataFrame):
        seen = Observation()
        norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
        rows = cut(rows.observe(seen, F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(norm).alias("most")), "vectors")
        self.n, self.width, self.most = seen.get["n"], seen.get["width"] or 0, seen.get["most"] or 0.0
        if self.most >= EXACT:
            raise ValueError("vectors too large for exact scores: 256 times their norm must stay below 2^26")
        drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, self.n // SAMPLE))) == 0).select("v").limit(2 * SAMPLE)
        sample = matrix(drawn.toArrow()["v"], self.width)
        size = max(1, -(-len(sample) // min(LEAVES, max(1, self.n // PART))))
        self.trunk = Tree.fit(augmented(sample, self.most), size)
        routed = rows.mapInArrow(router(self.trunk, self.width, self.most), "vec_id bigint, label bigint, v array<double>, leaf int")
        self.rows = cut(routed, "routed")
        #: A row a leaf, so of bounded size.
        self.leaves = cut(self.rows.groupBy("leaf").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")), "leaves")
        dealt = self.rows.join(F.broadcast(self.leaves), "leaf")
        part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part")
        branches = dealt.select("leaf", part, "vec_id", "label", "v").groupBy("leaf", "part")
        self.branches = cut(branches.applyInArrow(grower(self.width, self.most), BRANCH), "branches")

    def ask(self, windows: DataFrame, same: bool, k: int, home: bool = False, away: bool = False) -> DataFrame:
        """The best k of each part (anchor_id, top, vec_id, score) for windows (vec_id, label, v, leaf, floor, top).

        home: search the anchors' own leaves alone; away: all others.
        """
        counts = cut(windows.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "counts")  # a row a leaf
        nth = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
        dealt = windows.join(F.broadcast(counts), "leaf").withColumn("block", nth * LEAVES * 2 + F.col("leaf"))
        columns = ["block", "vec_id", "label", "v", "leaf", "floor", "top"]
        packs = dealt.select(columns).groupBy("block").applyInArrow(packer(self.trunk, self.width, self.most, away), BLOCK_TYPE)
        wanted = F.array((F.col("block") % (LEAVES * 2)).cast("int")) if home else F.col("leaves")
        asked = packs.select("block", *BLOCK_FIELDS, F.explode(wanted).alias("leaf")).join(F.broadcast(self.leaves), "leaf")
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        met = asked.join(self.branches, ["leaf", "part"])
        return met.groupBy("leaf", "part", "block").applyInArrow(
            searcher(self.width, self.most, same, k), "anchor_id bigint, top bigint, vec_id bigint, score bigint"
        )


def best(found: DataFrame, k: int) -> DataFrame:
    """The best k of each window, with their rank."""
    order = W.partitionBy("anchor_id", "top").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives_of(index: Index, anchors: DataFrame, k: int) -> DataFrame:
    """anchor_id, positive_id, positive_score: the first k other rows of the anchor's label."""
    whole = anchors.withColumn("floor", F.lit(-EXACT)).withColumn("top", F.lit(EXACT))
    first = cut(best(index.ask(whole, True, k, home=True), k), "home")
    bound = first.groupBy("anchor_id").agg(F.when(F.count("*") == k, F.min("score")).alias("found"))
    bounded = whole.join(bound.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left")
    bounded = bounded.withColumn("floor", F.coalesce("found", "floor")).drop("found")
    both = first.drop("rank").unionByName(index.ask(bounded, True, k, away=True))
    return best(both, k).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))


def hard_negatives(rows: DataFrame, anchors: Column, share: int = 80) -> DataFrame:
    """Negatives of each anchor and positive: rows of other labels that score at most as the positive, and at least share % of it.

    rows: as ``valid_rows`` gives them. anchors: which of them are anchors.
    """
    index = Index(rows)
    chosen = cut(index.rows.where(anchors), "anchors")
    positives = cut(positives_of(index, chosen, POSITIVES), "positives")
    tops = positives.where("positive_score >= 0").select(F.col("anchor_id").alias("vec_id"), F.col("positive_score").alias("top"))
    windows = chosen.join(tops.distinct(), "vec_id").withColumn("floor", F.expr(f"({share} * top + 99) div 100"))
    found = best(index.ask(cut(windows, "windows"), False, NEGATIVES), NEGATIVES)
    found = found.withColumnsRenamed({"top": "positive_score", "vec_id": "negative_id", "score": "negative_score"})
    return positives.join(found, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(valid_rows(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


OP13_SQL = r"""
WITH e AS (
  SELECT vec_id, min({'label': label, 'v': v}) AS row FROM (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
  GROUP BY vec_id),
r AS (SELECT vec_id, row.label AS label, row.v AS v FROM e),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
