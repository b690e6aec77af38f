"""Readers of place files: JSON arrays, JSON Lines and KML, as staged import rows with idx, and SQL folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType
from pyspark.sql.window import Window as W

from ..functions import bag, text
from .lines import located, with_index
from .scratch import scratch
from .sinks import located_at, matches

FIELDS = ["name", "category", "description", "photo_url", "address", "website", "hours"]

KML = StructType(
    [
        StructField("name", StringType()),
        StructField("description", StringType()),
        StructField("Point", StructType([StructField("coordinates", StringType())])),
        StructField(
            "ExtendedData",
            StructType(
                [
                    StructField(
                        "Data",
                        ArrayType(StructType([StructField("_name", StringType()), StructField("value", StringType())])),
                    )
                ]
            ),
        ),
    ]
)


class BadFile(ValueError):
    """A file that isn't what the import expects."""


def _json_string(value: Column, path: str) -> Column:
    """The field if it is a JSON string, else null."""
    kind = F.schema_of_variant(F.try_variant_get(value, f"$.{path}", "variant"))
    return F.when(kind == "STRING", F.try_variant_get(value, f"$.{path}", "string"))


def _json_number(value: Column, path: str) -> Column:
    """The field if it is a JSON number, else null: "12" is a string."""
    kind = F.schema_of_variant(F.try_variant_get(value, f"$.{path}", "variant"))
    return F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(value, f"$.{path}", "double"))


def read_json_places(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold one JSON array each -> idx, is_object, the text fields, lng, lat; elements keep their JSON types.

    idx numbers the elements of all files, in the order of their paths.
    Invalid JSON or another top-level value: BadFile. One array is one JSON value, so a file is parsed in one
    task; its elements are spread afterwards. Large files should come as JSON Lines, see ``read_json_line_places``.
    """
    texts = spark.read.text(path, wholetext=True)
    whole = texts.select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("doc"))
    kinds = {r[0] for r in whole.select(F.schema_of_variant("doc")).distinct().collect()}
    if not kinds or any(k is None or not k.startswith("ARRAY") for k in kinds):
        raise BadFile(f"{path} must hold a JSON array")
    n = F.size(F.col("doc").cast("array<variant>"))
    before = F.sum(n).over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))  # a row a file
    starts = whole.select("file", F.coalesce(before, F.lit(0)).alias("start"))
    items = whole.lateralJoin(spark.tvf.variant_explode(F.col("doc").outer())).select("file", "pos", "value")
    return _staged(items.join(starts, "file").select((F.col("pos") + F.col("start")).alias("idx"), "value"))


def read_json_line_places(spark: SparkSession, path: str) -> DataFrame:
    """Files with one JSON value a line -> the rows of ``read_json_places``. Spark splits files over tasks.

    idx numbers the lines of all files, in the order of their paths.
    Blank lines don't count; a line that isn't valid JSON: BadFile.
    """
    lines = spark.read.text(path).where(F.col("value").rlike(r"[^ \t\r]"))
    bad = lines.where(F.try_parse_json("value").isNull()).count()
    if bad:
        raise BadFile(f"{path} has {bad} lines that aren't JSON")
    placed = with_index(located(lines))
    return _staged(placed.select("idx", F.try_parse_json("value").alias("value")))


def _staged(items: DataFrame) -> DataFrame:
    """idx and a JSON value -> idx, is_object, the text fields, lng, lat."""
    is_object = F.coalesce(F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)"), F.lit(False))  # an array counts as one
    value = F.col("value")
    return items.select(
        "idx",
        is_object.alias("is_object"),
        *[_json_string(value, c).alias(c) for c in FIELDS],
        *[_json_number(value, c).alias(c) for c in ("lng", "lat")],
    )


def _as_js_text(value: Column) -> Column:
    """What is left of element text that an XML reader with value typing took for a number: nothing."""
    return F.when(text.trim(value).rlike(r"^[+-]?(0[xX][0-9a-fA-F]+|[0-9]*\.?[0-9]+([eE][+-]?[0-9]+)?)$"), F.lit("")).otherwise(value)


def kml_folders(spark: SparkSession, path: str) -> DataFrame:
    """file, folder: the name of a file's one folder, or "Uncategorized" when there is none or are several. A file without folders isn't listed."""
    schema = StructType([StructField("name", StringType())])
    folders = spark.read.format("xml").option("rowTag", "Folder").schema(schema).load(path)
    only = F.when(F.count("*") == 1, F.nullif(F.min("name"), F.lit("")))
    found = folders.select("name", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(only.alias("folder"))
    return found.select("file", F.coalesce("folder", F.lit("Uncategorized")).alias("folder"))


def read_kml_places(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """Placemarks at any depth of the files -> staged import rows; ``category`` goes before the name of the file's folder.

    Placemarks without a readable point, in range, or without a name are dropped, as the import does; idx numbers the others.
    """
    marks = located(spark.read.format("xml").option("rowTag", "Placemark").schema(KML).load(path))
    fields = F.transform(
        F.coalesce("ExtendedData.Data", F.array().cast("array<struct<_name:string,value:string>>")),
        lambda d: F.struct(d["_name"].alias("name"), d["value"].alias("value")),
    )
    if category:
        marks = marks.withColumn("label", F.lit(category))
    else:
        folders = kml_folders(spark, path).withColumnsRenamed({"file": "_file", "folder": "label"})
        marks = marks.join(folders, "_file", "left").fillna("Uncategorized", ["label"])
    cleaned = _cleaned_marks(marks, F.col("name"), F.col("description"), F.col("Point.coordinates"), fields, ["_file", "_block"])
    return with_index(cleaned).select("idx", *STAGED)


STAGED = ["name", "category", "description", "photo_url", "address", "website", "hours", "lng", "lat"]


def _cleaned_marks(marks: DataFrame, name: Column, description: Column, coordinates: Column, fields: Column, place: list[str]) -> DataFrame:
    """Staged columns, and those of ``place``, of the marks with a name and a readable point. marks: with label."""
    raw = F.col("raw")
    cleaned = marks.select(
        *place,
        F.col("label").alias("category"),
        text.trim(text.strip_cdata(_as_js_text(name))).alias("name"),
        text.strip_cdata(_as_js_text(description)).alias("raw"),
        text.parse_coordinates(coordinates).alias("at"),
        bag.tidy(fields).alias("bag"),
    ).where(F.col("at").isNotNull() & (F.col("name") != ""))
    return cleaned.select(
        *place,
        "name",
        "category",
        text.blank_to_null(bag.description(raw, F.col("bag"))).alias("description"),
        F.lit(None).cast("string").alias("photo_url"),
        bag.address(F.col("bag")).alias("address"),
        bag.website(F.col("bag"), raw).alias("website"),
        F.lit(None).cast("string").alias("hours"),
        F.col("at.lng").alias("lng"),
        F.col("at.lat").alias("lat"),
    )


#: Levels of elements that a document may have.
MOST_LEVELS = 200


def kml_nodes(spark: SparkSession, path: str) -> DataFrame:
    """file, place, node, label: elements of any tag and depth that have a Point and a name, in documents read as trees.

    What lies inside of such an element isn't looked at. place orders the elements of a file: by tag within an element, then as they stand.
    label is the name of the document's one folder, or "Uncategorized". A document is one value, so it is parsed in one task;
    from then on each level's elements are rows. The levels are written to the shared folder in turn.
    """
    options = {"rowTag": "kml", "singleVariantColumn": "node", "locale": "ar-EG"}  # by whose separators "1,2,0" is no number, but a string
    docs = spark.read.format("xml").options(**options).load(path)
    folder = F.nullif(F.try_variant_get("node", "$.Document.Folder.name", "string"), F.lit(""))
    now = docs.select(F.col("_metadata.file_path").alias("file"), F.lit("").alias("place"), "node", F.coalesce(folder, F.lit("Uncategorized")).alias("label"))
    has = lambda key: F.schema_of_variant(F.try_variant_get("node", f"$.{key}", "variant")).isNotNull()
    is_mark = F.schema_of_variant("node").startswith("OBJECT") & has("Point") & has("name")
    found: DataFrame | None = None
    for _ in range(MOST_LEVELS):
        level = scratch(spark, "level")
        now.withColumn("mark", F.coalesce(is_mark, F.lit(False))).write.parquet(level)
        kept = spark.read.parquet(level)
        marks = kept.where("mark").drop("mark")
        found = marks if found is None else found.unionByName(marks)
        inner = kept.where(~F.col("mark") & F.schema_of_variant("node").rlike("^(OBJECT|ARRAY)"))
        if inner.isEmpty():
            return found
        children = inner.withColumnRenamed("node", "above").lateralJoin(spark.tvf.variant_explode(F.col("above").outer()))
        now = children.select("file", F.concat("place", F.lpad(F.col("pos").cast("string"), 9, "0")).alias("place"), F.col("value").alias("node"), "label")
    raise BadFile(f"{path} has more than {MOST_LEVELS} levels of elements")


def read_kml_tree(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """The rows of ``read_kml_places`` for elements of any tag with a point and a name, see ``kml_nodes``."""
    nodes = kml_nodes(spark, path)
    if category:
        nodes = nodes.withColumn("label", F.lit(category))
    get = lambda at, kind: F.try_variant_get("node", f"$.{at}", kind)
    one = "struct<_name:string,value:string>"
    data = F.coalesce(get("ExtendedData.Data", f"array<{one}>"), F.array_compact(F.array(get("ExtendedData.Data", one))))
    fields = F.transform(data, lambda d: F.struct(d["_name"].alias("name"), d["value"].alias("value")))
    string = lambda at: F.coalesce(get(at, "string"), F.lit(""))  # noqa: E731  an element with attributes is no string
    cleaned = _cleaned_marks(nodes, string("name"), string("description"), get("Point.coordinates", "string"), fields, ["file", "place"])
    placed = numbered(cleaned.withColumn("order", F.struct("file", "place")), "order")
    return placed.select(F.col("idx").cast("bigint").alias("idx"), *STAGED)


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """idx from 0 in the order of a column, without one task for all rows: counts per range, then offsets.

    The ranges are written and each range's place is a column of its rows, so a task that runs again finds the same ones.
    """
    spark = rows.sparkSession
    path = scratch(spark, "numbered")
    placed = rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    offsets = counts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(W.partitionBy("_part").orderBy(order)) - 1
    return placed.join(F.broadcast(offsets), "_part").withColumn("idx", local + F.col("_before")).drop("_part", "_before")


def read_sql_files(spark: SparkSession, folder: str) -> DataFrame:
    """filename, sql of the *.sql files of a folder, or of its folders filename=*.sql, as Spark writes them; readers sort by filename.

    Files are listed with their folder, once; only folders filename=*.sql are listed one by one, by tasks.
    """
    if matches(spark, f"{folder}/filename=*.sql"):
        texts = spark.read.text(f"{folder}/*.sql", wholetext=True)
    else:
        depth = located_at(spark, folder)[1].rstrip("/").count("/") + 1  # folders within, such as a=1, are neither read nor partitions
        listed = spark.read.option("pathGlobFilter", "*.sql").option("recursiveFileLookup", "true").text(folder, wholetext=True)
        texts = listed.where(F.regexp_count(F.regexp_replace("_metadata.file_path", r"^[^/:]+:(//[^/]*)?", ""), F.lit("/")) == depth)
    return texts.select(
        F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"(?:filename=)?([^/=]+\.sql)(?:/[^/]*)?$", 1).alias("filename"), F.col("value").alias("sql")
    )
