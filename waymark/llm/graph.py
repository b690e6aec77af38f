"""Connected components of an edge table by alternating stars, in a logarithmic number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut


def _nearest(edges: DataFrame) -> tuple[DataFrame, bool]:
    """The least of each node and its neighbours, written, and whether the edges are stars around least nodes.

    They are if no node has two lesser neighbours, or a lesser one and a larger one.
    """
    both = edges.select("a", "b", F.lit(True).alias("down")).union(edges.select("b", "a", F.lit(False)))
    nodes = both.groupBy("a").agg(
        F.least(F.min("b"), F.col("a")).alias("m"), F.count_if("down").alias("lesser"), F.count_if(~F.col("down")).alias("larger")
    )
    seen = Observation()
    amiss = F.count_if((F.col("lesser") > 1) | ((F.col("lesser") == 1) & (F.col("larger") > 0))).alias("amiss")
    written = cut(nodes.observe(seen, amiss).select("a", "m"), "least")
    return written, not seen.get["amiss"]


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (node, root) for every node that has an edge; root is the least node reachable.

    Each round links every larger neighbour of a node to the node's least neighbour, then
    every smaller one; rounds end when the edges are stars. Each round's edges, and what comes out, are written to the
    shared folder.
    Nodes with many neighbours are aggregated before they are joined, and the aggregate is written
    first, so that a join with such a node can be split. No edges: no rows.
    """
    now = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    least, stars = _nearest(now)
    while not stars:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large, "large")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        least, stars = _nearest(now)
    return least.select(F.col("a").alias("node"), F.col("m").alias("root"))
