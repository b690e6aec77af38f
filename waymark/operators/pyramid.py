"""Far views of places without reading all of them: the first places of each tile, level by level.

A far view shows the first FAR_LIMIT places by id in a box. For each tile of each level, and each category, the pyramid holds the first
FAR_LIMIT places, which are all that a view of a whole tile can show. A view takes the tiles that it covers from the pyramid, and
reads places for its edges alone; the world is the one tile of level 0. Writes keep the pyramid up to date from the rows they write.
"""

from __future__ import annotations

from math import ceil, floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..sources.scratch import scratch
from .viewport import FAR_LIMIT, FEATURE_COLUMNS, Box, in_box, limit_for

#: Levels 0 to LEVELS - 1; a level has 2^level by 2^level tiles.
LEVELS = 6
#: A tile counts as covered if the box goes so many degrees beyond it.
MARGIN = 1e-9
#: Bits of a cell key for each of lng and lat.
KEY_BITS = 16
GROUP = ["level", "tile", "category"]


def tile_at(level: Column | int, lng: str = "lng", lat: str = "lat") -> Column:
    """The number of a place's tile at a level; places beyond the world's edge lie in the tiles there."""
    n = F.pow(F.lit(2.0), F.lit(level) if isinstance(level, int) else level)
    along = lambda share: F.least(F.greatest(F.floor(share * n), F.lit(0)), n.cast("bigint") - 1)
    return along((F.col(lat) + 90) / 180) * n.cast("bigint") + along((F.col(lng) + 180) / 360)


def cell_key(lng: str = "lng", lat: str = "lat", bits: int = KEY_BITS) -> Column:
    """Bits of lng and lat in turn: places whose keys are near lie near each other."""
    key = F.lit(0).cast("bigint")
    for share, shift in (((F.col(lng) + 180) / 360, 0), ((F.col(lat) + 90) / 180, 1)):
        whole = F.least(F.greatest(F.floor(share * (1 << bits)), F.lit(0)), F.lit((1 << bits) - 1))
        for bit in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(whole, bit).bitwiseAND(F.lit(1)), 2 * bit + shift))
    return key


def first_of(rows: DataFrame) -> DataFrame:
    """The first FAR_LIMIT rows by id of each group; each task keeps as many before rows are moved.

    Rows are dealt out evenly before that, so what a task sorts doesn't grow with the files it comes from.
    """
    by = W.partitionBy(*GROUP).orderBy("id")
    return rows.hint("rebalance").withColumn("_nth", F.row_number().over(by)).where(F.col("_nth") <= FAR_LIMIT).drop("_nth")


def tiled(places: DataFrame, level: int = LEVELS - 1) -> DataFrame:
    """The places with their tile at a level."""
    return places.select(*FEATURE_COLUMNS, F.lit(level).alias("level"), tile_at(level).alias("tile"))


def rolled_up(last: DataFrame) -> DataFrame:
    """All levels from the last one's rows: the first of a tile are among the first of its four tiles a level below.

    Each level is written to the shared folder, and the one above it reads no more than that.
    """
    spark, rows = last.sparkSession, last
    every: DataFrame | None = None
    for level in reversed(range(LEVELS)):
        if every is not None:
            rows = first_of(tiled(rows, level))
        path = scratch(spark, "level")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        every = rows if every is None else every.unionByName(rows)
    return every


def pyramid(places: DataFrame) -> DataFrame:
    """level, tile and the feature columns."""
    return rolled_up(first_of(tiled(places)))


def refreshed(before: DataFrame, places: DataFrame, written: DataFrame) -> DataFrame:
    """The pyramid after rows were written: places is the table as it is now, written its new rows (ids stay in their places).

    Written rows replace themselves in the last level. A group that had all of FAR_LIMIT rows and lost one, as its category changed, may
    have one more to show: such groups alone are read anew. The other levels follow from the last.
    """
    ids, now = written.select("id"), tiled(written)
    held = before.where(F.col("level") == LEVELS - 1).select(now.columns)
    lost = held.join(ids, "id", "left_semi").join(now.select("id", *GROUP), ["id", *GROUP], "left_anti").select(*GROUP).distinct()
    full = held.groupBy(*GROUP).count().where(F.col("count") == FAR_LIMIT).join(lost, GROUP, "left_semi").select(*GROUP)
    again = tiled(places).join(full, GROUP, "left_semi").select(now.columns)
    kept = held.join(ids, "id", "left_anti").select(now.columns).unionByName(now).join(full, GROUP, "left_anti").select(now.columns)
    return rolled_up(first_of(kept.unionByName(again))).select(before.columns)


def covered(box: Box, most: int = 4) -> tuple[int, list[int]]:
    """A level, and its tiles that lie in the box: about ``most`` by ``most`` of them."""
    if box.is_world:
        return 0, [0]
    width = max(box.east - box.west, 2 * (box.north - box.south), 1e-6)
    level = max(0, min(LEVELS - 1, ceil(log2(360 / width * most))))
    n = 1 << level
    first = lambda at, low, size: ceil((at + MARGIN - low) * n / size)
    last = lambda at, low, size: floor((at - MARGIN - low) * n / size) - 1
    xs = range(max(first(box.west, -180, 360), 0), min(last(box.east, -180, 360), n - 1) + 1)
    ys = range(max(first(box.south, -90, 180), 0), min(last(box.north, -90, 180), n - 1) + 1)
    return level, [y * n + x for y in ys for x in xs]


def far_view(tiles: DataFrame, places: DataFrame, box: Box, zoom: float = 0, category: str | None = None) -> DataFrame:
    """The rows of ``viewport`` for a far zoom, from a pyramid and, at the edges of the box, the places."""
    if limit_for(zoom) > FAR_LIMIT:
        raise ValueError(f"zoom {zoom} shows more places than the pyramid has")
    level, whole = covered(box)
    found = tiles.where((F.col("level") == level) & F.col("tile").isin(whole)).select(FEATURE_COLUMNS)
    if not box.is_world:
        edge = places.where(in_box(box) & ~tile_at(level).isin(whole)).select(FEATURE_COLUMNS)
        found = found.unionByName(edge)
    if category is not None:
        found = found.where(F.col("category") == category)
    return found.orderBy("id").limit(limit_for(zoom))
