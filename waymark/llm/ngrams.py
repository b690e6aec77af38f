"""Jaccard join of word n-gram sets by rare-first prefix filtering.

All n-grams have one order, rare ones first: by a count, then by hash. Counts of all documents are kept in SLOTS counters to
which n-grams are hashed, so their table has a fixed size; a counter tells n-grams that are frequent from the noise of the
others, and any order gives the same result. Two sets that are similar enough share an n-gram within their first few:

1. Documents with equal sets form a class; its node is its least doc_id.
2. Prefix filter: a set of n goes with its first n - ceil(t n) + 1 n-grams. Of a pair the shorter set must even hold the shared one
   among its first n - ceil(2t/(1+t) n) + 1 ("indexed"), so n-grams that no set has there join nothing.
3. In the bucket of an n-gram the shortest indexed node, its hub, is paired with the others. Pairs are listed once, and
   sieved: by length; by position (what the prefixes share, and what may follow); by suffix (what may follow, summed over
   BINS parts of the hash space). Those left are verified on the full sets, once.
4. Nodes of a bucket that the hub didn't join to one component are paired among each other, if they are few (PAIRED), and
   go through the same sieve and check once; larger rests are compared in blocks, from which only links between components come out.

So no link between different texts is lost, and a group of n near copies costs n checks, not n^2.

Defined results:
- null or empty text, or only blanks: no n-grams, linked with nothing;
- rows with a null doc_id are linked with nothing: component null;
- repeated rows are one document: each comes back with the same component;
- rows of one doc_id with different texts each go by their text; texts whose least doc_id is the same share their links;
- an empty table gives no rows; further input columns are ignored; texts may be of any length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .graph import components
from .minmax import class_of, compare_blocks, confirm, labelled, open_members, sets_of
from .tokens import U64, groups, shingle_sets, shingles_of, words_of

#: Counters of n-grams, by the upper bits of their hash; they travel in segments.
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
SEGMENT = 1 << 14
#: Rounds in which the tasks' counters are summed: into so many tables each.
SUMS = (16, 1)
#: Parts of the hash space for the suffix filter.
BINS = 64
#: Rests of a bucket with up to so many nodes are paired, larger ones compared in blocks.
PAIRED = 32


def slots_of(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(64 - SLOT_BITS)).astype(np.int64)


def bins_of(grams: np.ndarray) -> np.ndarray:
    return np.bincount((grams & U64(BINS - 1)).astype(np.int64), minlength=BINS)


def counter(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of a task's n-grams, in segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(SLOTS, np.uint32), [], 0
        for batch in batches:
            for _, _, texts in groups(batch.column("text")):
                slots = slots_of(shingles_of(words_of(texts), size)[0])
                waiting.append(slots)
                held += len(slots)
                if held >= SLOTS:
                    total += np.bincount(np.concatenate(waiting), minlength=SLOTS).astype(np.uint32)
                    waiting, held = [], 0
        if held:
            total += np.bincount(np.concatenate(waiting), minlength=SLOTS).astype(np.uint32)
        yield from segments(total.reshape(-1, SEGMENT))

    return run


def segments(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for n, counts in enumerate(total):
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([counts.tobytes()])], ["segment", "counts"])


def adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of segments; counters stop at 2^32 - 1."""
    total = np.zeros((SLOTS // SEGMENT, SEGMENT), np.uint32)
    for batch in batches:
        for n, counts in zip(batch.column("segment").to_pylist(), batch.column("counts").to_pylist()):
            now = total[n].astype(np.uint64) + np.frombuffer(counts, np.uint32)
            total[n] = np.minimum(now, (1 << 32) - 1).astype(np.uint32)
    yield from segments(total)


def gram_counts(docs: DataFrame, size: int) -> np.ndarray:
    """The counters (of a fixed size) of all n-grams of all documents."""
    kind = "segment int, counts binary"
    found = docs.select("text").mapInArrow(counter(size), kind).withColumn("part", F.xxhash64("counts"))
    for parts in SUMS:
        found = found.repartition("segment", F.pmod("part", F.lit(parts))).select("segment", "counts").mapInArrow(adder, kind)
        found = found.withColumn("part", F.xxhash64("counts"))
    total = np.zeros((SLOTS // SEGMENT, SEGMENT), np.uint32)
    for row in found.select("segment", "counts").collect():  # a row a segment
        total[row.segment] = np.frombuffer(row.counts, np.uint32)
    return total.reshape(-1)


def prefixes(n: int, percent: int) -> tuple[int, int]:
    """How many of n n-grams are the prefix, and how many are indexed."""
    return n + 1 - -(-percent * n // 100), n + 1 - -(-2 * percent * n // (100 + percent))


SIGNED = "doc_id bigint, n bigint, class binary, prefix array<bigint>, indexed int, bins binary"


def signer(size: int, percent: int, counts: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, texts in groups(batch.column("text")):
                names, heads, indexed, bins, n = [], [], [], [], []
                for grams in shingle_sets(words_of(texts), size):
                    n.append(len(grams))
                    if not len(grams):
                        for column in (names, heads, indexed, bins):
                            column.append(None)
                        continue
                    long, short = prefixes(len(grams), percent)
                    names.append(class_of(grams))
                    heads.append(grams[np.argsort(counts[slots_of(grams)], kind="stable")[:long]].view(np.int64))
                    indexed.append(short)
                    bins.append(bins_of(grams).astype(np.uint32).tobytes())
                columns = [
                    batch.column("doc_id")[at:to].cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(heads, pa.list_(pa.int64())),
                    pa.array(indexed, pa.int32()),
                    pa.array(bins, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "class", "prefix", "indexed", "bins"])

    return run


def most_common(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, bins_a: np.ndarray, bins_b: np.ndarray, counts: np.ndarray) -> int:
    """What two sets may share at most, by their prefixes and bins.

    Up to the last n-gram of the prefix that ends first, both prefixes are whole, so what they share there is known; behind it the
    shorter rest is a bound (position), and so is the sum over bins of the smaller of two counts (suffix).
    """
    last_a, last_b = ((int(counts[slots_of(x[-1:])[0]]), int(x[-1])) for x in (a, b))
    if last_b < last_a:
        a, b, n_a, n_b, bins_a, bins_b, last_a = b, a, n_b, n_a, bins_b, bins_a, last_b
    count, gram = counts[slots_of(b)], b
    b = b[(count < last_a[0]) | ((count == last_a[0]) & (gram <= U64(last_a[1])))]
    common = len(np.intersect1d(a, b, assume_unique=True))
    rest = np.minimum(bins_a - bins_of(a), bins_b - bins_of(b)).sum()
    return common + min(n_a - len(a), n_b - len(b), int(rest))


def siever(percent: int, counts: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pairs (a, b) whose sets may share enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sides = [[batch.column(f"{c}_{s}") for c in ("n", "prefix", "bins")] for s in "ab"]
            for i in range(batch.num_rows):
                (n_a, a, bins_a), (n_b, b, bins_b) = (
                    (n[i].as_py(), p[i].values.to_numpy().view(U64), np.frombuffer(s[i].as_buffer(), np.uint32).astype(np.int64))
                    for n, p, s in sides
                )
                need = -(-percent * (n_a + n_b) // (100 + percent))
                keep.append(most_common(a, b, n_a, n_b, bins_a, bins_b, counts) >= need)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def sieve(pairs: DataFrame, classes: DataFrame, percent: int, counts: np.ndarray) -> DataFrame:
    """Distinct pairs (a, b) that pass the filters by position and suffix. The side with many pairs comes last, so its
    data isn't sent once a pair."""
    a, b = (classes.selectExpr(f"node AS {s}", f"n AS n_{s}", f"prefix AS prefix_{s}", f"bins AS bins_{s}") for s in "ab")
    return pairs.join(b, "b").join(a, "a").mapInArrow(siever(percent, counts), "a bigint, b bigint")


def within(percent: int, short: str, long: str) -> str:
    return f"100 * {short} >= {percent} * {long}"


def link(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class, component_id, kept of every row of ``docs``."""
    counts = gram_counts(docs, size)
    signed = cut(docs.select("doc_id", "text").mapInArrow(signer(size, percent, counts), SIGNED), "signed")
    firsts = [F.first(c).alias(c) for c in ("n", "prefix", "indexed", "bins")]
    classes = cut(
        signed.where("doc_id IS NOT NULL AND class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("node"), *firsts),
        "classes",
    )
    posted = classes.select("node", "n", "indexed", F.posexplode("prefix").alias("place", "band")).select(
        "band", "node", "n", (F.col("place") < F.col("indexed")).alias("first")
    )
    hubs = posted.groupBy("band").agg(
        F.count("*").alias("many"), F.min(F.when(F.col("first"), F.struct("n", "node"))).alias("hub")
    )
    hubs = hubs.where("many > 1 AND hub IS NOT NULL").select("band", "hub")
    spokes = posted.join(hubs, "band").where("struct(n, node) > hub")
    spokes = cut(spokes.select("band", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), "node", "n", "first"), "spokes")
    stars = spokes.where(within(percent, "hub_n", "n")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    stars = cut(sieve(stars, classes, percent, counts), "stars")
    rests = spokes.groupBy("band").agg(F.count("*").alias("many"), F.count_if("first").alias("firsts"))
    rests = rests.where("many > 1 AND firsts > 0").select("band")
    rest = spokes.join(rests, "band").select("band", "node", "n", "first")
    nodes = stars.select(F.col("a").alias("node")).union(stars.select("b")).union(rest.select("node")).distinct()
    sets = sets_of(docs, signed, cut(nodes, "nodes"), size)
    found = components(confirm(stars, sets, percent))
    members, few = open_members(rest, found, "first"), F.col("many") <= PAIRED
    one = members.where(few).selectExpr("band", "node AS a", "n AS n_a", "root AS root_a", "first AS first_a")
    two = members.where(few).selectExpr("band", "node AS b", "n AS n_b", "root AS root_b")
    pairs = one.join(two, "band").where(f"first_a AND root_a != root_b AND struct(n_a, a) < struct(n_b, b) AND {within(percent, 'n_a', 'n_b')}")
    pairs = cut(sieve(pairs.select("a", "b").distinct(), classes, percent, counts), "pairs")
    rooted = found.select(F.col("node").alias("a"), "root")
    links = confirm(pairs, sets, percent).join(rooted, "a", "left").select(F.coalesce("root", "a").alias("a"), "b")
    rooted = rooted.withColumnRenamed("a", "b")
    links = links.join(rooted, "b", "left").select("a", F.coalesce("root", "b").alias("b"))
    joined = components(links.union(compare_blocks(members.where(~few), sets, percent)))
    return labelled(signed, classes, found, joined)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
