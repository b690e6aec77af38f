"""Viewport queries: places in a bounding box, by zoom and category, and their GeoJSON shape."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Result limits by zoom and what counts as a view of the world, in degrees.
FAR_ZOOM, FAR_LIMIT, NEAR_LIMIT = 6, 500, 5000
WORLD_WIDTH, WORLD_HEIGHT = 300, 160

FEATURE_COLUMNS = ["id", "lng", "lat", "name", "category", "photo_url"]


@dataclass(frozen=True)
class Box:
    west: float
    south: float
    east: float
    north: float

    @property
    def is_world(self) -> bool:
        return self.east - self.west > WORLD_WIDTH or self.north - self.south > WORLD_HEIGHT


class BadRequest(ValueError):
    """A request that can't be understood (status 400)."""


def _number(text: str) -> float:
    """A number as a browser reads it: blanks around it don't matter, and nothing is 0."""
    text = text.strip()
    if not text:
        return 0.0
    if text.lower().lstrip("+-") in ("inf", "infinity", "nan") and text.lstrip("+-") != "Infinity" or "_" in text:
        raise ValueError(text)
    return float(int(text, 0)) if text[:2].lower() in ("0x", "0o", "0b") else float(text)


def parse_box(text: str | None) -> Box:
    """'west,south,east,north'; missing, another number of parts or no numbers: BadRequest."""
    if not text:
        raise BadRequest("bbox query parameter is required")
    parts = text.split(",")
    try:
        west, south, east, north = map(_number, parts)
    except ValueError:
        raise BadRequest("bbox must be minLng,minLat,maxLng,maxLat") from None
    return Box(west, south, east, north)


def parse_zoom(text: str | None) -> float:
    """0 where zoom is missing or isn't a number."""
    try:
        return _number(text or "0")
    except ValueError:
        return 0.0


def number(text: Column) -> Column:
    """``_number`` of a column; null for what is no number."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    digits = F.substring(t, 3, 60)
    out = F.when(t == "", 0.0).when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    for base, letters, digit in ((16, "xX", "0-9a-fA-F"), (8, "oO", "0-7"), (2, "bB", "01")):
        out = out.when(t.rlike(f"^0[{letters}][{digit}]+$"), F.conv(digits, base, 10).cast("double"))
    return out.when(t.rlike("^[+-]?Infinity$"), F.replace(t, F.lit("+"), F.lit("")).try_cast("double"))


def understood(requests: DataFrame, box: str = "box", zoom: str = "zoom_text") -> DataFrame:
    """Requests with status, west, south, east, north, zoom and most, the limit that follows; all null but the status where it is 400."""
    parts = F.split(F.nullif(F.col(box), F.lit("")), ",")
    sides = F.transform(parts, number)
    good = F.coalesce((F.size(sides) == 4) & F.forall(sides, lambda x: x.isNotNull()), F.lit(False))
    level = F.coalesce(number(F.coalesce(F.col(zoom), F.lit(""))), F.lit(0.0))
    out = requests.withColumn("status", F.when(good, 200).otherwise(400))
    named = {name: F.when(good, F.get(sides, F.lit(n))) for n, name in enumerate(("west", "south", "east", "north"))}
    return out.withColumns(named | {"zoom": F.when(good, level), "most": F.when(good, F.when(level < FAR_ZOOM, FAR_LIMIT).otherwise(NEAR_LIMIT))})


def limit_for(zoom: float) -> int:
    return FAR_LIMIT if zoom < FAR_ZOOM else NEAR_LIMIT


def in_box(box: Box) -> Column:
    """All four sides belong to the box; a box whose west lies east of its east side is empty."""
    return F.col("lng").between(box.west, box.east) & F.col("lat").between(box.south, box.north)


def viewport(places: DataFrame, box: Box, zoom: float = 0, category: str | None = None) -> DataFrame:
    """The places of a view, by id up to the zoom's limit. A view of the world has no spatial filter; '' is a category.

    The order makes the limited result repeatable. The filters reach the Parquet scan, and
    the limit is a top-k of each task, so one task gets at most limit rows of each.
    """
    found = places.select(FEATURE_COLUMNS)
    if not box.is_world:
        found = found.where(in_box(box))
    if category is not None:
        found = found.where(F.col("category") == category)
    return found.orderBy("id").limit(limit_for(zoom))


def point(lng: str = "lng", lat: str = "lat") -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates"))


def features(found: DataFrame) -> DataFrame:
    """One GeoJSON feature struct a row; a null photo stays a null property."""
    return found.select(
        F.struct(
            F.lit("Feature").alias("type"),
            F.col("id"),
            point().alias("geometry"),
            F.struct("id", "name", "category", "photo_url").alias("properties"),
        ).alias("feature")
    )


def collection(found: DataFrame) -> DataFrame:
    """One row, also of no places: type and features in id order. The input is a viewport, so at most NEAR_LIMIT rows."""
    gathered = features(found).agg(F.array_sort(F.collect_list("feature"), lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)).alias("features"))
    return gathered.select(F.lit("FeatureCollection").alias("type"), "features")


def as_json(document: DataFrame) -> DataFrame:
    """The document as JSON text with its nulls kept."""
    return document.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def near(places: DataFrame) -> DataFrame:
    """``places`` laid out for box filters: sorted by a key of interleaved bits, so that files and row groups cover small areas."""
    from .pyramid import cell_key

    return places.withColumn("cell", cell_key()).repartitionByRange("cell").sortWithinPartitions("cell").drop("cell")
