"""Lookups, categories, counts and clusters of places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .viewport import point

DETAIL = ["id", "name", "category", "description", "photo_url", "address", "website", "hours", "lng", "lat"]
#: Cluster radius in pixels, last zoom that clusters, least points; circle sizes from so many points.
RADIUS, LAST_ZOOM, LEAST_POINTS = 20, 10, 3
SIZES = [(1000, 19), (100, 16), (10, 13), (0, 10)]
TILE = 512


def detail(places: DataFrame, id: str) -> DataFrame:
    """The place of an id with its point: one row or none."""
    return places.where(F.col("id") == id).select(*DETAIL, point().alias("geometry")).limit(1)


def first_or(df: DataFrame, default: dict) -> DataFrame:
    """The first row, or one of defaults. For results of at most a few rows."""
    rows = df.limit(1)
    spare = df.sparkSession.range(1).select(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in default.items()])
    return spare.join(rows.select(F.lit(1).alias("_found")), F.lit(True), "left").where("_found IS NULL").drop("_found").unionByName(rows.select(list(default)))


def categories(places: DataFrame, collation: str | None = None) -> DataFrame:
    """Distinct categories in order: of their bytes, or of a collation such as UNICODE or UNICODE_CI.

    Spellings that a collation takes for equal stay apart, as in a database with a deterministic one; ties go by bytes.
    """
    by = [F.collate("category", collation)] if collation else []
    return places.select("category").distinct().orderBy(*by, "category")


def distinct_by(places: DataFrame, collation: str, column: str = "category") -> DataFrame:
    """One spelling, the least by bytes, of those that a collation takes for equal; in its order."""
    found = places.where(F.col(column).isNotNull()).groupBy(F.collate(column, collation).alias("_key")).agg(F.min(column).alias(column))
    return found.orderBy("_key").select(column)


def numbered_labels(rows: DataFrame, column: str, collation: str = "UNICODE") -> DataFrame:
    """Distinct labels and their place, from 1, in the order of a collation. Labels must be few: they are numbered in one task."""
    by = W.orderBy(F.collate(column, collation), column)
    return rows.select(column).distinct().withColumn("place", F.row_number().over(by).cast("long"))


def category_list(places: DataFrame) -> DataFrame:
    """One row with the sorted categories: a set, so copies are merged before they are gathered."""
    return places.agg(F.array_sort(F.collect_set("category")).alias("categories"))


def count_rows(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """The number of rows, as an int; of those that meet the condition if there is one."""
    return (df if condition is None else df.where(condition)).agg(F.count("*").cast("int").alias("n"))


def histogram(rows: DataFrame, column: str = "category", order: str = "idx") -> DataFrame:
    """Counts of a column, the most frequent first; equal counts in order of first sight."""
    counted = rows.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
    return counted.orderBy(F.desc("n"), "first_seen")


def size_class(points: Column) -> Column:
    out = F.when(points >= SIZES[0][0], SIZES[0][1])
    for least, size in SIZES[1:]:
        out = out.when(points >= least, size)
    return out


def clusters(places: DataFrame, zoom: int) -> DataFrame:
    """Grid clusters: places whose mercator pixels share a square of twice RADIUS; squares of few points stay points.

    This is a grid of our own definition, an approximation of what map clients draw.
    Beyond LAST_ZOOM every place stays a point. Columns: cell_x, cell_y, point_count
    (null for a point), id (null for a cluster), lng, lat (mean), size.
    """
    if zoom > LAST_ZOOM:
        return places.select(
            *[F.lit(None).cast("bigint").alias(c) for c in ("cell_x", "cell_y", "point_count")],
            "id",
            "lng",
            "lat",
            F.lit(None).cast("int").alias("size"),
        )
    world = float(TILE * 2**zoom)
    lat = F.greatest(F.lit(-85.0511), F.least(F.lit(85.0511), F.col("lat")))
    x = (F.col("lng") + 180) / 360 * world
    y = (0.5 - F.log(F.tan(F.radians(45 + lat / 2))) / (2 * F.pi())) * world
    placed = places.select(
        "id", "lng", "lat", F.floor(x / (2 * RADIUS)).alias("cell_x"), F.floor(y / (2 * RADIUS)).alias("cell_y")
    )
    cells = placed.groupBy("cell_x", "cell_y").agg(
        F.count("*").alias("point_count"), F.avg("lng").alias("c_lng"), F.avg("lat").alias("c_lat")
    )
    grouped = cells.where(F.col("point_count") >= LEAST_POINTS).select(
        "cell_x",
        "cell_y",
        "point_count",
        F.lit(None).cast("string").alias("id"),
        F.col("c_lng").alias("lng"),
        F.col("c_lat").alias("lat"),
        size_class(F.col("point_count")).alias("size"),
    )
    few = cells.where(F.col("point_count") < LEAST_POINTS).select("cell_x", "cell_y")
    points = placed.join(few, ["cell_x", "cell_y"], "left_semi").select(
        "cell_x", "cell_y", F.lit(None).cast("bigint").alias("point_count"), "id", "lng", "lat", F.lit(None).cast("int").alias("size")
    )
    return grouped.unionByName(points)
