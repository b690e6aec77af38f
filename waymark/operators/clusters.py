"""Clusters of places by radius, zoom level by zoom level, as a tree.

At each level from LAST_ZOOM down, the nodes (places, and clusters of the level before) are swept in a fixed order: a node that
no leader has taken becomes a leader and takes all others within the radius that are still free. Leaders that come to
LEAST_POINTS places become clusters at the mean of their places; the others' nodes stay what they are.

The order is one that cells can be swept in at once: the plane is cut into cells in which any two nodes are within the radius, and
the cells are dealt to nine colours, so that two cells of a colour are farther apart than the radius. Nodes go by colour,
then by points (most first), then by id. So of each cell of a colour the first free node is its one leader: an aggregate by cell, which
is combined before it is shuffled however many places a cell has, and a join with the leaders of nearby cells. A level takes nine such
steps, whatever the data. From the level on at which FEW nodes are left, which low zooms always come to, as there are few cells, one task sweeps
them node by node in the same order.

Coordinates are whole numbers, 2^31 to the world's width, so that means and distances are exact and reruns agree.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch
from .places import LAST_ZOOM, LEAST_POINTS, RADIUS, TILE, size_class

WORLD_BITS = 31
COLOURS = 9
#: Cells that a node's radius may reach, either way.
REACH = 2
#: So many nodes are swept by one task.
FEW = 50_000


def radius_at(zoom: int) -> int:
    return RADIUS * (1 << WORLD_BITS) // (TILE << zoom)


def projected(places: DataFrame) -> DataFrame:
    """id, n, x, y: web mercator, latitudes beyond 85.0511 at the edge. Places without coordinates take no part."""
    lat = F.greatest(F.lit(-85.0511), F.least(F.lit(85.0511), F.col("lat")))
    y = 0.5 - F.log(F.tan(F.radians(45 + lat / 2))) / (2 * F.pi())
    whole = lambda c: F.floor(c * F.lit(float(1 << WORLD_BITS)))
    sound = "lng IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lng) AND NOT isnan(lat)"
    return places.where(sound).select("id", F.lit(1).cast("long").alias("n"), whole((F.col("lng") + 180) / 360).alias("x"), whole(y).alias("y"))


def unprojected(x: Column, y: Column) -> list[Column]:
    world = F.lit(float(1 << WORLD_BITS))
    lng = x / world * 360 - 180
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp((F.lit(0.5) - y / world) * 2 * F.pi()))) - 90
    return [lng.alias("lng"), lat.alias("lat")]


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def leaders_of(nodes: DataFrame, radius: int) -> DataFrame:
    """The leaders (cx, cy: a cell that they reach, colour, n, id, x, y) among nodes (id, n, x, y, cx, cy, colour), a row for each cell in reach."""
    found: DataFrame | None = None
    for colour in range(COLOURS):
        free = nodes.where(F.col("colour") == colour)
        if found is not None:
            theirs = found.select("cx", "cy", F.col("x").alias("lx"), F.col("y").alias("ly"))
            close = (free.cx == theirs.cx) & (free.cy == theirs.cy) & within(radius, "x", "y", "lx", "ly")
            free = free.join(theirs, close, "left_anti")
        first = F.min_by(F.struct("n", "id", "x", "y"), F.struct(-F.col("n"), "id")).alias("l")
        lead = free.groupBy("cx", "cy").agg(first).select("cx", "cy", F.lit(colour).alias("colour"), "l.*")
        steps = F.sequence(F.lit(-REACH), F.lit(REACH))
        spread = lead.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
        spread = spread.withColumns({"cx": F.col("cx") + F.col("dx"), "cy": F.col("cy") + F.col("dy")}).drop("dx", "dy")
        spread = _kept(spread, "leaders")
        found = spread if found is None else found.unionByName(spread)
    return found


def within(radius: int, ax: str, ay: str, bx: str, by: str) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy <= F.lit(radius * radius)


def level(nodes: DataFrame, zoom: int) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, zoom, n, x, y) of the level above to (those of ``zoom``, the taken ones with parent_id)."""
    radius = radius_at(zoom)
    side = isqrt(radius * radius // 2)
    cells = nodes.withColumns({"cx": F.expr(f"x div {side}"), "cy": F.expr(f"y div {side}")})
    cells = _kept(cells.withColumn("colour", (F.pmod("cx", F.lit(3)) * 3 + F.pmod("cy", F.lit(3))).cast("int")), "nodes")
    leaders = leaders_of(cells, radius)
    theirs = leaders.select("cx", "cy", "colour", *[F.col(c).alias(f"l{c}") for c in ("n", "id", "x", "y")])
    near = cells.drop("colour").join(theirs, ["cx", "cy"]).where(within(radius, "x", "y", "lx", "ly"))
    taker = F.min_by("lid", F.struct("colour", -F.col("ln"), "lid")).alias("leader")
    same = [F.first(c).alias(c) for c in ("zoom", "n", "x", "y")]  # one row a node and leader
    taken = _kept(near.groupBy("id").agg(taker, *same), "taken")
    mean = lambda c: (F.sum((F.col("n") * F.col(c)).cast("decimal(38,0)")) / F.sum("n").cast("decimal(20,0)")).cast("long")
    groups = taken.groupBy("leader").agg(F.sum("n").alias("total"), F.count("*").alias("members"), mean("x").alias("x"), mean("y").alias("y"))
    formed = groups.where(f"members > 1 AND total >= {LEAST_POINTS}")
    made = formed.select(F.concat(F.lit(f"{zoom}:"), "leader").alias("id"), F.lit(zoom).alias("zoom"), F.col("total").alias("n"), "x", "y")
    which = formed.select("leader", F.concat(F.lit(f"{zoom}:"), "leader").alias("parent_id"))
    placed = _kept(taken.join(which, "leader", "left"), "placed")
    own = ["id", "zoom", "n", "x", "y"]
    stay = placed.where("parent_id IS NULL").select(own)
    return made.select(own).unionByName(stay), placed.where("parent_id IS NOT NULL").select(*own, "parent_id")


def sweep(nodes: dict[str, tuple], zoom: int) -> tuple[dict[str, tuple], list[tuple]]:
    """The same, node by node, for a few: {id: (zoom, n, x, y)} to those of the level, and rows of the taken ones."""
    radius = radius_at(zoom)
    side = isqrt(radius * radius // 2)
    cells: dict[tuple[int, int], list[str]] = defaultdict(list)
    for i, (_, _, x, y) in nodes.items():
        cells[x // side, y // side].append(i)
    order = sorted(nodes, key=lambda i: ((nodes[i][2] // side % 3) * 3 + nodes[i][3] // side % 3, -nodes[i][1], i))
    near = range(-REACH, REACH + 1)
    done: set[str] = set()
    left, taken = {}, []
    for lead in order:
        if lead in done:
            continue
        _, _, x, y = nodes[lead]
        group = []
        for dx in near:
            for dy in near:
                cell = (x // side + dx, y // side + dy)
                close = [i for i in cells.get(cell, ()) if (nodes[i][2] - x) ** 2 + (nodes[i][3] - y) ** 2 <= radius * radius]
                if close:
                    group += close
                    cells[cell] = [i for i in cells[cell] if i not in set(close)]
        done.update(group)
        total = sum(nodes[i][1] for i in group)
        if len(group) > 1 and total >= LEAST_POINTS:
            name = f"{zoom}:{lead}"
            left[name] = (zoom, total, *(sum(nodes[i][1] * nodes[i][c] for i in group) // total for c in (2, 3)))
            taken += [(i, *nodes[i], name) for i in group]
        else:
            left |= {i: nodes[i] for i in group}
    return left, taken


TREE = "id string, zoom int, n bigint, x bigint, y bigint, parent_id string"


def sweeper(first: int, last: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All nodes of one task, a few, through several levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = {}
        for batch in batches:
            for i, *rest in zip(*(batch.column(c).to_pylist() for c in ("id", "zoom", "n", "x", "y"))):
                nodes[i] = tuple(rest)
        rows: list[tuple] = []
        for zoom in range(first, last - 1, -1):
            nodes, taken = sweep(nodes, zoom)
            rows += taken
        rows += [(i, *v, None) for i, v in nodes.items()]
        names = ["id", "zoom", "n", "x", "y", "parent_id"]
        types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def cluster_tree(places: DataFrame, first: int = LAST_ZOOM, last: int = 0) -> DataFrame:
    """All nodes: id, zoom at which it was made (places: first + 1), n (places in it), x, y, parent_id (null at the top).

    The id of a cluster is its zoom and its leader's id. ids of places must differ, and a null id has no node.
    """
    now = _kept(projected(places.where("id IS NOT NULL")).withColumn("zoom", F.lit(first + 1)).select("id", "zoom", "n", "x", "y"), "nodes")
    out: DataFrame | None = None
    for zoom in range(first, last - 1, -1):
        if now.limit(FEW + 1).count() <= FEW:
            top = now.coalesce(1).mapInArrow(sweeper(zoom, last), TREE)
            break
        above, taken = level(now, zoom)
        now = _kept(above, "level")
        out = taken if out is None else out.unionByName(taken)
    else:
        top = now.withColumn("parent_id", F.lit(None).cast("string"))
    return top if out is None else out.unionByName(top)


def visible(tree: DataFrame, zoom: int) -> DataFrame:
    """What a map shows at a zoom: id, point_count and size (null for a place), lng, lat."""
    above = F.coalesce(F.substring_index("parent_id", ":", 1).cast("int"), F.lit(-1))
    shown = tree.where((F.col("zoom") >= zoom) & (above < zoom))
    is_place = F.col("n") == 1  # a cluster has more
    return shown.select(
        "id",
        F.when(~is_place, F.col("n")).alias("point_count"),
        F.when(~is_place, size_class(F.col("n"))).alias("size"),
        *unprojected(F.col("x"), F.col("y")),
    )
