"""Registered queries that write files to the shared folder and read them again, and those of request texts and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .operators import integrity, upsert, users as U, viewport as V
from .plans import imports
from .queries import FOLD_SQL, query, with_
from .schemas import PLACES, PREFERENCES
from .sources import derived as D, dump, files, sinks
from .sources.scratch import scratch
from .streaming import preferences as live

STOPS_SQL = """
stops AS (
  SELECT s_suppkey AS key, s_name AS name, CASE WHEN s_suppkey % 5 > 0 THEN 'Stop' END AS category,
    CAST(s_suppkey % 380 - 170 AS DOUBLE) AS lng, CAST(s_suppkey % 180 - 90 AS DOUBLE) AS lat
  FROM supplier)"""


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return D.table(spark, sf_dir, "supplier").select(
        key.alias("key"),
        F.col("s_name").alias("name"),
        F.when(key % 5 > 0, "Stop").alias("category"),
        (key % 380 - 170).cast("double").alias("lng"),
        (key % 180 - 90).cast("double").alias("lat"),
    )


@query(
    "json_array_file",
    with_(STOPS_SQL)
    + """SELECT CAST(row_number() OVER (ORDER BY key) - 1 AS BIGINT) AS idx, key % 9 > 0 AS is_object, CASE WHEN key % 9 > 0 THEN name END AS name,
  CASE WHEN key % 9 > 0 THEN category END AS category, CASE WHEN key % 9 > 0 AND key % 7 > 0 THEN lng END AS lng, CASE WHEN key % 9 > 0 THEN lat END AS lat FROM stops""",
)
def json_array_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one JSON array each: objects, some with a number written as text, and bare numbers between them."""
    path = scratch(spark, "array")
    as_text = F.when(F.col("key") % 7 == 0, F.col("lng").cast("string"))
    objects = F.when(as_text.isNotNull(), F.to_json(F.struct("name", "category", as_text.alias("lng"), "lat"))).otherwise(
        F.to_json(F.struct("name", "category", "lng", "lat"))
    )
    item = F.when(F.col("key") % 9 > 0, objects).otherwise(F.col("key").cast("string"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("key", item.alias("item")))), lambda r: r["item"])
    arrays = stops(spark, sf_dir).groupBy(part_of_keys()).agg(F.concat(F.lit("[\n"), F.array_join(items, ",\n"), F.lit("]")).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return files.read_json_places(spark, path).select("idx", "is_object", "name", "category", "lng", "lat")


def part_of_keys() -> Column:
    """A name for each 500 keys, in their order: the rows of a file."""
    return F.lpad(F.floor(F.col("key") / 500).cast("string"), 12, "0").alias("part")


@query(
    "json_lines_file",
    "SELECT c_name AS name, c_mktsegment AS category, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lng, CAST(c_custkey % 180 - 90 AS DOUBLE) AS lat,"
    " CAST(row_number() OVER (ORDER BY c_custkey % 7 < 3, c_custkey) - 1 AS BIGINT) AS idx FROM customer",
)
def json_lines_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of files, the larger one last: idx is the order of paths and lines, however Spark packs the files."""
    path = scratch(spark, "lines")
    key = F.col("c_custkey")
    rows = D.table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
        (key % 360 - 180).cast("double").alias("lng"),
        (key % 180 - 90).cast("double").alias("lat"),
        (key % 7 < 3).alias("late"),
        key.alias("key"),
    )
    for late in (False, True):
        ordered = rows.where(F.col("late") == late).repartitionByRange("key").sortWithinPartitions("key")
        ordered.select(F.to_json(F.struct("name", "category", "lng", "lat")).alias("value")).write.text(f"{path}/late={late}")
    return files.read_json_line_places(spark, f"{path}/late=*").select("name", "category", "lng", "lat", "idx")


@query(
    "kml_file",
    with_(STOPS_SQL)
    + """SELECT 'Depots' AS category, name, CASE WHEN key % 2 = 0 THEN 'note & more ' || key END AS description, lng, lat
FROM stops WHERE lng BETWEEN -180 AND 180""",
)
def kml_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of placemarks inside one folder each; those out of range are left out, as are blank descriptions."""
    path = scratch(spark, "kml")
    note = F.when(F.col("key") % 2 == 0, F.format_string("<description><![CDATA[note & more %d]]></description>", "key")).otherwise("")
    at = F.format_string("<Point><coordinates>%s,%s,0</coordinates></Point>", F.col("lng").cast("string"), F.col("lat").cast("string"))
    mark = F.concat(F.lit("<Placemark><name> "), "name", F.lit(" </name>"), note, at, F.lit("</Placemark>"))
    marks = F.array_join(F.array_sort(F.collect_list(mark)), "\n")
    head = '<?xml version="1.0"?>\n<kml><Document><Folder><name>Depots</name>\n'
    documents = stops(spark, sf_dir).groupBy(part_of_keys()).agg(F.concat(F.lit(head), marks, F.lit("\n</Folder></Document></kml>")).alias("value"))
    documents.write.partitionBy("part").text(path)
    return files.read_kml_places(spark, path).select("category", "name", "description", "lng", "lat")


@query(
    "kml_tree",
    with_(STOPS_SQL)
    + """SELECT CAST(row_number() OVER (ORDER BY key // 500, key % 2 = 0, key) - 1 AS BIGINT) AS idx, 'Depots' AS category, name,
  CASE WHEN key % 3 = 0 THEN 'City ' || key END AS address, lng, lat FROM stops WHERE lng BETWEEN -180 AND 180""",
)
def kml_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read as trees: stops of another tag in a folder inside the folder, and what lies inside of a stop isn't one."""
    path, key = scratch(spark, "kml"), F.col("key")
    at = F.format_string("<Point><coordinates>%s,%s,0</coordinates></Point>", F.col("lng").cast("string"), F.col("lat").cast("string"))
    city = F.format_string('<ExtendedData><Data name="Location City"><value>City %d</value></Data></ExtendedData>', "key")
    body = F.concat(F.lit("<name> "), "name", F.lit(" </name>"), at, F.when(key % 3 == 0, city).otherwise(""))
    within = F.concat(F.lit("<Stop>"), body, F.lit("<Inner><name>x</name><Point><coordinates>1,1</coordinates></Point></Inner></Stop>"))
    mark = F.when(key % 2 == 0, F.concat(F.lit("<Placemark>"), body, F.lit("</Placemark>"))).otherwise(within)
    listed = lambda odd: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.when(key % 2 == odd, F.struct("key", mark.alias("mark"))))), lambda r: r["mark"]), "\n"
    )
    head = "<kml><Document><Folder><name>Depots</name>\n"
    folder = F.concat(F.lit(head), F.lit("<Folder>"), listed(1), F.lit("</Folder>"), listed(0), F.lit("\n</Folder></Document></kml>"))
    stops(spark, sf_dir).groupBy(part_of_keys()).agg(folder.alias("value")).write.partitionBy("part").text(path)
    return files.read_kml_tree(spark, path).select("idx", "category", "name", "address", "lng", "lat")


@query(
    "sql_folder",
    "SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') || '__' || lower(replace(s_name, '#', '_')) || '.sql' AS filename,"
    " 'CREATE TABLE t' || s_suppkey || ' (id int);' || chr(10) || '-- ' || s_name || chr(10) AS sql FROM supplier",
)
def sql_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of migrations, one a supplier, written by the tasks, and a file of another kind that isn't read."""
    folder, key = scratch(spark, "migrations"), F.col("s_suppkey").cast("string")
    name = F.concat(F.lpad(key, 6, "0"), F.lit("__"), F.lower(F.replace("s_name", F.lit("#"), F.lit("_"))), F.lit(".sql"))
    sql = F.concat(F.lit("CREATE TABLE t"), key, F.lit(" (id int);\n-- "), "s_name")
    sinks.write_sql_files(D.table(spark, sf_dir, "supplier").select(name.alias("filename"), sql.alias("sql")), folder)
    sinks.write_file(spark, f"{folder}/README.md", "not a migration")
    return files.read_sql_files(spark, folder)


PLACE_ROWS_SQL = "SELECT id, name, category, description, photo_url, address, website, hours, lng, lat, created_at FROM places"


@query("backup_and_restore", with_(D.PLACES_SQL) + PLACE_ROWS_SQL)
def backup_and_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back up a table, lose its rows, restore it."""
    table, folder = scratch(spark, "places"), scratch(spark, "backup")
    sinks.replace_table(D.places(spark, sf_dir), table)
    sinks.backup(spark, {"places": table}, folder)
    sinks.replace_table(spark.createDataFrame([], PLACES), table)
    sinks.restore(spark, folder, {"places": table}, confirmed=True)
    return spark.read.parquet(table)


@query(
    "dump_and_restore",
    with_(D.PLACES_SQL, D.USERS_SQL)
    + r"""SELECT id, name || chr(9) || 'two' AS name, category, replace(description, 'Place ', 'COPY public.users (id) FROM stdin;' || chr(10) || '\.' || chr(13) || '\N\') AS description,
  lng, lat, created_at, (SELECT count(*) FROM users WHERE is_guest) AS guests FROM places""",
)
def dump_and_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables through a dump of text and back into tables that had other rows; texts hold what marks rows and sections."""
    folder, places, users = (scratch(spark, n) for n in ("dump", "places", "users"))
    odd = "COPY public.users (id) FROM stdin;\n\\.\r\\N\\"
    rows = D.places(spark, sf_dir).select(
        "id", F.concat("name", F.lit("\ttwo")).alias("name"), "category", F.replace("description", F.lit("Place "), F.lit(odd)).alias("description"), "lng", "lat", "created_at"
    )
    people = D.users(spark, sf_dir)
    schemas = {"users": people.schema, "places": rows.schema}
    for path, df in ((places, rows.limit(3)), (users, people.limit(3))):
        df.write.parquet(path)
    dump.write_dump(spark, {"users": people, "places": rows}, folder)
    dump.restore_dump(spark, folder, {"users": users, "places": places}, schemas, confirmed=True)
    guests = spark.read.parquet(users).agg(F.count_if("is_guest").alias("guests"))
    return spark.read.parquet(places).join(F.broadcast(guests))


@query(
    "restore_schemas",
    with_(D.PLACES_SQL)
    + """SELECT column_name, CAST(0 AS BIGINT) AS n_rows FROM (SELECT unnest(list_sort(map_keys(json_transform(to_json(p), '"MAP(VARCHAR, VARCHAR)"')))) AS column_name
FROM (SELECT * FROM places LIMIT 1) p)""",
)
def restore_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a table that was made anew from its backup's schema, and its rows: none."""
    table, folder = scratch(spark, "places"), scratch(spark, "backup")
    sinks.replace_table(D.places(spark, sf_dir), table)
    sinks.backup(spark, {"places": table}, folder)
    sinks.restore_schemas(spark, folder, {"places": table}, confirmed=True)
    made = spark.read.parquet(table)
    columns = integrity.columns_of({"places": made.schema}, spark).select("column_name")
    return columns.join(F.broadcast(made.agg(F.count("*").alias("n_rows"))))


@query(
    "copy_database",
    with_(D.PLACES_SQL, D.USERS_SQL)
    + "SELECT 'places' AS table_name, count(*) AS n, min(id) AS least, max(id) AS most FROM places UNION ALL SELECT 'users', count(*), min(id), max(id) FROM users",
)
def copy_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {"places": scratch(spark, "places"), "users": scratch(spark, "users")}
    target = {name: scratch(spark, f"copy-{name}") for name in source}
    sinks.replace_table(D.places(spark, sf_dir), source["places"])
    sinks.replace_table(D.users(spark, sf_dir), source["users"])
    sinks.copy_database(spark, source, target)
    counts = [
        spark.read.parquet(path).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"))
        for name, path in sorted(target.items())
    ]
    return counts[0].unionByName(counts[1])


@query("schema_artifact", "SELECT table_name, count(*) - (table_name = 'part')::INT AS n_columns FROM information_schema.columns WHERE table_name IN ('nation', 'part') GROUP BY table_name")
def schema_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given tables that have drifted from the saved schemas, with the columns that they have now: one is new, one lost a column."""
    path = scratch(spark, "schemas")
    now = {name: D.table(spark, sf_dir, name).schema for name in ("customer", "part", "region", "supplier")}
    sinks.save_schemas(spark, now, path)
    now |= {"nation": D.table(spark, sf_dir, "nation").schema, "part": now["part"][:-1]}
    drifted = sinks.schema_drift(spark, now, path)
    columns = integrity.columns_of({t: now[t] for t in drifted}, spark)
    return columns.groupBy("table_name").agg(F.count("*").alias("n_columns"))


@query(
    "feature_document",
    with_(D.PLACES_SQL)
    + "SELECT 'FeatureCollection' AS type, 'Feature' AS kind, 'Point' AS shape, lng, lat, id, name, category, photo_url FROM places"
    " WHERE lng >= -60 AND lat >= -40 AND lng <= 60 AND lat <= 40 ORDER BY id LIMIT 5000",
)
def feature_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature collection written as a JSON file, and read back to one row a feature."""
    path = scratch(spark, "features")
    sinks.write_json(V.as_json(V.collection(V.viewport(D.places(spark, sf_dir), V.Box(-60, -40, 60, 40), 7))), path)
    feature = (
        "struct<type:string,geometry:struct<type:string,coordinates:array<double>>,"
        "properties:struct<id:string,name:string,category:string,photo_url:string>>"
    )
    schema = f"type string, features array<{feature}>"
    document = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("d"))
    rows = document.select("d.type", F.explode("d.features").alias("f"))
    return rows.select(
        "type",
        F.col("f.type").alias("kind"),
        F.col("f.geometry.type").alias("shape"),
        F.get("f.geometry.coordinates", F.lit(0)).alias("lng"),
        F.get("f.geometry.coordinates", F.lit(1)).alias("lat"),
        "f.properties.*",
    )


@query(
    "request_boxes",
    """WITH asked AS (SELECT event_id, event_id % 8 AS kind, event_id % 5 AS z, event_id % 300 - 150 AS w, event_id % 100 - 50 AS s FROM events)
SELECT event_id, CASE WHEN kind IN (0, 1, 2, 7) THEN 200 ELSE 400 END AS status,
  CAST(CASE kind WHEN 0 THEN w WHEN 1 THEN w WHEN 2 THEN 0 WHEN 7 THEN 31 END AS DOUBLE) AS west,
  CAST(CASE kind WHEN 0 THEN s WHEN 1 THEN s WHEN 2 THEN 0 WHEN 7 THEN 3 END AS DOUBLE) AS south,
  CAST(CASE kind WHEN 0 THEN w + 20 WHEN 1 THEN w + 20 WHEN 2 THEN 0 WHEN 7 THEN 0.5 END AS DOUBLE) AS east,
  CAST(CASE kind WHEN 0 THEN s + 10 WHEN 1 THEN s + 10 WHEN 2 THEN 0 WHEN 7 THEN 0.5 END AS DOUBLE) AS north,
  CASE WHEN kind IN (0, 1, 2, 7) THEN CAST(CASE z WHEN 0 THEN 7 WHEN 1 THEN 5.9 ELSE 0 END AS DOUBLE) END AS zoom,
  CASE WHEN kind IN (0, 1, 2, 7) THEN CASE z WHEN 0 THEN 5000 ELSE 500 END END AS most FROM asked""",
)
def request_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a request: what is understood of its box and zoom, or status 400."""
    n = F.col("event_id")
    w, s, e, t = (c.cast("string") for c in (n % 300 - 150, n % 100 - 50, n % 300 - 130, n % 100 - 40))
    written = [
        F.concat_ws(",", w, s, e, t), F.concat(F.lit(" "), w, F.lit(" ,\t"), s, F.lit(", "), e, F.lit(" ,"), t, F.lit("\n")), F.lit(",,,"),
        F.concat_ws(",", w, s, e), F.concat_ws(",", w, s, e, F.lit("x")), F.lit(""), F.lit(None).cast("string"), F.lit("0x1F,0b11,5e-1,.5"),
    ]
    zooms = F.array(F.lit("7"), F.lit(" 5.9"), F.lit("x"), F.lit(""), F.lit(None).cast("string"))
    asked = D.table(spark, sf_dir, "events").select(
        n, F.get(F.array(*written), (n % 8).cast("int")).alias("box"), F.get(zooms, (n % 5).cast("int")).alias("zoom_text")
    )
    return V.understood(asked).drop("box", "zoom_text")


@query(
    "linked_descriptions",
    """SELECT s_suppkey AS key,
  'See <a href="https://x.example/' || s_suppkey || '?a=1&amp;b=2">https://x.example/' || s_suppkey || '?a=1&amp;b=2</a>, or &lt;b&gt; <a href="https://www.y.example/' || s_suppkey || '">www.y.example/' || s_suppkey || '</a>. &amp; &quot;more&quot;' AS linked,
  CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '<A class="z" href="/k/' || s_suppkey || '">here & now</A>'
    ELSE 'no. ' || s_suppkey || ' &lt;i&gt;' END AS prepared,
  '<p><strong>N</strong> </p><a href="https://x.example/' || s_suppkey || '" target="_blank" rel="noopener noreferrer">t</a> x<br><a>u</a>' AS sanitised
FROM supplier""",
)
def linked_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    plain = F.concat(F.lit("See https://x.example/"), key, F.lit("?a=1&b=2, or <b> www.y.example/"), key, F.lit('. & "more"'))
    some = (
        F.when(F.col("s_suppkey") % 3 == 0, " \t\n")
        .when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit('<A class="z" href="/k/'), key, F.lit('">here & now</A>')))
        .otherwise(F.concat(F.lit("no. "), key, F.lit(" <i>")))
    )
    rich = F.concat(
        F.lit('<p onclick="x()"><strong>N</strong> <script>alert(1)</script></p><a class="c" href="https://x.example/'),
        key,
        F.lit('">t</a> <img src=x>x<br><a href="javascript:y">u</a>'),
    )
    return D.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"),
        text.linkify(plain).alias("linked"),
        text.prepare_description(some).alias("prepared"),
        text.sanitise(rich).alias("sanitised"),
    )


@query(
    "upsert_stamps",
    with_(STOPS_SQL)
    + """SELECT lng, lat, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS id, TRUE AS stamped
FROM (SELECT DISTINCT lng, lat, sha256(lng || ',' || lat) AS h FROM stops)""",
)
def upsert_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted places: ids made from their keys, and the time of writing."""
    none = F.lit(None).cast("string")
    rows = stops(spark, sf_dir).select(
        F.col("key").alias("idx"), "name", F.lit("Stop").alias("category"), "lng", "lat",
        *[none.alias(c) for c in ("description", "photo_url", "address", "website", "hours")],
    )
    written = upsert.upsert_places(spark.createDataFrame([], PLACES), rows)
    near = F.abs(F.unix_timestamp("created_at") - F.unix_timestamp(F.current_timestamp())) < 3600
    return written.select("lng", "lat", "id", near.alias("stamped"))


@query(
    "import_failures",
    with_(STOPS_SQL)
    + """, kept AS (SELECT * FROM stops WHERE lng BETWEEN -180 AND 180),
places AS (SELECT lng, lat, max(key) AS key FROM kept GROUP BY lng, lat),
failed AS (SELECT count(*) AS n FROM kept WHERE (lng, lat) = (SELECT (lng, lat) FROM kept ORDER BY key LIMIT 1))
SELECT (SELECT count(*) FROM kept) - n AS inserted, n AS failed, (SELECT count(*) FROM places) AS rows_then FROM failed""",
)
def import_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import of which one place can't be written, since another place has its id: the others are, and it is told."""
    none, table = F.lit(None).cast("string"), scratch(spark, "places")
    staged = stops(spark, sf_dir).select(
        F.col("key").alias("idx"), "name", F.lit("Stop").alias("category"), "lng", "lat",
        *[none.alias(c) for c in ("description", "photo_url", "address", "website", "hours")],
    )
    first = staged.where("lng BETWEEN -180 AND 180").orderBy("idx").limit(1)
    blocker = first.select(upsert.place_id(F.col("lng"), F.col("lat")).alias("id"), "name", "category", F.lit(999.0).alias("lng"), F.lit(0.0).alias("lat"))
    for c in PLACES.names:
        if c not in blocker.columns:
            blocker = blocker.withColumn(c, F.lit(None).cast(PLACES[c].dataType))
    sinks.replace_table(blocker.select(PLACES.names), table)
    outcome = imports.run_import(staged, spark.read.parquet(table), table)
    return spark.read.parquet(table).agg(
        F.lit(outcome.inserted).cast("long").alias("inserted"), F.lit(outcome.failed).cast("long").alias("failed"), F.count("*").alias("rows_then")
    )


@query(
    "catalog_constraints",
    with_(D.PLACES_SQL, D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL)
    + """SELECT table_name, kind, definition, CASE WHEN kind = 'unique' THEN (SELECT count(*) FROM (SELECT 1 FROM places GROUP BY lng, lat HAVING count(*) > 1))
  WHEN kind = 'reference' THEN (SELECT count(*) FROM preferences WHERE user_id NOT IN (SELECT id FROM users)) ELSE 0 END AS n
FROM (VALUES ('places', 'key', 'id'), ('places', 'unique', 'lng,lat'), ('users', 'key', 'id'), ('users', 'check', 'tier IN (free, premium)'),
  ('preferences', 'key', 'user_id'), ('preferences', 'reference', 'user_id -> users.id'), ('ledger', 'key', 'filename')) t(table_name, kind, definition)""",
)
def catalog_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared constraints, each with what breaks it."""
    preferences = U.fold_preferences(D.preference_patches(spark, sf_dir))
    return integrity.constraint_report(D.places(spark, sf_dir), D.users(spark, sf_dir), preferences, D.ledger(spark, sf_dir))


@query("repeated_preferences", "SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'map-2' AS basemap_id, CAST(2 AS DOUBLE) AS last_zoom FROM customer")
def repeated_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows of each user to write: the later one counts, and each user has one row."""
    users = D.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    empty = F.lit(None).cast("double")
    source = users.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "user_id", "n", F.concat(F.lit("map-"), F.col("n").cast("string")).alias("basemap_id"),
        empty.alias("last_center_lng"), empty.alias("last_center_lat"), F.col("n").cast("double").alias("last_zoom"),
    )
    target = spark.createDataFrame([], PREFERENCES)
    return upsert.upsert_preferences(target, source, "n").select("user_id", "basemap_id", "last_zoom")


# --- streams ----------------------------------------------------------------------------


@query("preference_stream", with_(D.PATCHES_SQL, FOLD_SQL) + "SELECT * FROM preferences")
def preference_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patches as a stream: they arrive up to ten minutes late, in three folders of files, and the stream is stopped
    after each and goes on from its checkpoint. A heartbeat of no user, a day later, lets the last users fall quiet."""
    log, path, checkpoint = D.preference_patches(spark, sf_dir), scratch(spark, "arrivals"), scratch(spark, "checkpoint")
    patches = log.withColumn("ts", F.col("ts").cast("timestamp"))  # a watermark asks for instants
    sink = live.PreferenceSink(scratch(spark, "saved"))
    at = F.unix_seconds("ts") + F.col("event_id") * 37 % 600
    first, last = patches.agg(F.min(at), F.max(at)).first()
    third = F.least(F.floor((at - F.lit(first)) * 3 / F.lit((last or 0) - (first or 0) + 1)), F.lit(2))
    heartbeat = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.timestamp_seconds(F.lit((last or 0) + 86_400)).alias("ts") for f in patches.schema]
    )
    for n in range(3):
        arrived = patches.where(third == n)
        (arrived.unionByName(heartbeat) if n == 2 else arrived).write.mode("append").parquet(path)
        stream = spark.readStream.schema(patches.schema).parquet(path)
        live.keep_preferences(stream, sink, checkpoint, lateness="20 minutes").awaitTermination()
    return sink.table(spark).withColumn("updated_at", F.col("updated_at").cast(log.schema["ts"].dataType))
