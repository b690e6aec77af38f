"""Registered queries of the application's requests, each as it is answered from the tables, and of tables laid out by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import pyramid, users as U, viewport as V
from .plans import imports, requests
from .queries import FOLD_SQL, VALID_SQL, query, validated, with_
from .sources import derived as D, layout
from .sources.scratch import scratch

FEATURES = "type string, features array<struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:struct<id:string,name:string,category:string,photo_url:string>>>"


@query(
    "request_places",
    with_(D.PLACES_SQL)
    + """SELECT 'FeatureCollection' AS type, lng, lat, id, name, category, photo_url FROM places
WHERE lng BETWEEN -120.5 AND 31 AND lat BETWEEN -40 AND 40 AND category = 'MACHINERY' ORDER BY id LIMIT 5000""",
)
def request_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GET of a view with a category: the JSON document, read back to a row a feature."""
    answer = requests.get_places(D.places(spark, sf_dir), " -120.5,-40,0x1F,40", "6.5", "MACHINERY")
    found = answer.select(F.from_json("json", FEATURES).alias("d")).select("d.type", F.explode("d.features").alias("f"))
    at, own = "f.geometry.coordinates", "f.properties"
    return found.select(
        "type", F.get(at, F.lit(0)).alias("lng"), F.get(at, F.lit(1)).alias("lat"), *[f"{own}.{c}" for c in ("id", "name", "category", "photo_url")]
    )


@query("request_place", with_(D.PLACES_SQL) + "SELECT id, name, category, description, photo_url, address, website, hours, lng, lat FROM places WHERE id = '11'")
def request_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.get_place(D.places(spark, sf_dir), "11").drop("geometry")


@query("request_categories", with_(D.PLACES_SQL) + "SELECT string_agg(category, ',' ORDER BY category) AS categories FROM (SELECT DISTINCT category FROM places)")
def request_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.get_categories(D.places(spark, sf_dir)).select(F.array_join("categories", ",").alias("categories"))


@query(
    "request_me",
    with_(D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL)
    + f"""SELECT id AS user_id, display_name, tier, basemap_id, last_zoom, CASE WHEN tier = 'premium' THEN {len(U.PROVIDERS)} ELSE {len(U.FREE)} END AS n_providers
FROM users LEFT JOIN preferences ON user_id = id WHERE id = '7'""",
)
def request_me(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GET of the session of one user."""
    found = requests.get_me(D.users(spark, sf_dir), U.fold_preferences(D.preference_patches(spark, sf_dir)), "7")
    return found.select(
        F.col("userId").alias("user_id"), F.col("displayName").alias("display_name"), "tier",
        F.col("preferences.basemapId").alias("basemap_id"), F.col("preferences.lastZoom").alias("last_zoom"), F.size("allowedProviders").alias("n_providers"),
    )


@query(
    "request_patch",
    with_(D.PATCHES_SQL, FOLD_SQL)
    + """SELECT user_id, CASE WHEN user_id = '7' THEN NULL ELSE basemap_id END AS basemap_id, CASE WHEN user_id = '7' THEN 1.5 ELSE last_center_lng END AS last_center_lng,
  CASE WHEN user_id = '7' THEN -2 ELSE last_center_lat END AS last_center_lat, last_zoom FROM preferences""",
)
def request_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PATCH of one user: null clears the basemap, the zoom isn't in the patch and stays."""
    table = U.fold_preferences(D.preference_patches(spark, sf_dir))
    return requests.patch_preferences(table, "7", {"basemapId": None, "lastCenter": [1.5, -2]}).drop("updated_at")


@query(
    "request_credentials",
    with_(D.USERS_SQL)
    + """SELECT tier, CASE WHEN tier = 'premium' THEN 200 ELSE 403 END AS status, CASE WHEN tier = 'premium' THEN 'secret' END AS api_key FROM users WHERE id = '5'""",
)
def request_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.get_credentials(D.users(spark, sf_dir), "thunderforest-outdoors", {"thunderforest": "secret"}, "5").select("tier", "status", "api_key")


@query(
    "sessions_by_bucket",
    with_(D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL) + "SELECT id AS user_id, display_name, tier, basemap_id, last_zoom FROM users LEFT JOIN preferences ON user_id = id",
)
def sessions_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions from tables that lie in buckets by user, joined without a shuffle."""
    users = layout.bucketed(D.users(spark, sf_dir), "users", "id", scratch(spark, "users"))
    saved = layout.bucketed(U.fold_preferences(D.preference_patches(spark, sf_dir)), "preferences", "user_id", scratch(spark, "preferences"))
    found = U.sessions(users, saved)
    return found.select(
        F.col("userId").alias("user_id"), F.col("displayName").alias("display_name"), "tier",
        F.col("preferences.basemapId").alias("basemap_id"), F.col("preferences.lastZoom").alias("last_zoom"),
    )


@query(
    "import_reasons",
    with_(D.STAGED_SQL, D.PLACES_SQL, VALID_SQL)
    + """SELECT reason, count(*) AS n, min(idx) AS first_idx FROM (
  SELECT idx, CASE WHEN name LIKE 'Stop 1%' THEN 'name: too long' WHEN category = 'view' THEN 'category: not allowed'
    WHEN EXISTS (SELECT 1 FROM places p WHERE p.lng = c.lng AND p.lat = c.lat) THEN 'lng, lat: already there' END AS reason FROM cleaned c) GROUP BY reason""",
)
def import_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned rows by the first constraint of a table that each breaks (null: none)."""
    checks = [
        imports.Check("name: too long", ~F.col("name").startswith("Stop 1")),
        imports.Check("category: not allowed", F.col("category") != "view"),
    ]
    cleaned = imports.clean(validated(spark, sf_dir))
    told = imports.with_reason(cleaned, D.places(spark, sf_dir), checks, unique=[["lng", "lat"]])
    return told.groupBy("reason").agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"))


@query(
    "import_reconciled",
    with_(D.STAGED_SQL, D.PLACES_SQL, VALID_SQL)
    + """, counted AS (SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid FROM validated),
failed AS (SELECT count(*) AS n FROM cleaned WHERE name LIKE 'Stop 1%')
SELECT total, valid, total - valid AS invalid, valid - n AS inserted, n AS failed, n = 0 AS success FROM counted, failed""",
)
def import_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account of an import of which some rows break a check of the table."""
    rows = validated(spark, sf_dir)
    told = imports.with_reason(imports.clean(rows), D.places(spark, sf_dir), [imports.Check("name: too long", ~F.col("name").startswith("Stop 1"))])
    return imports.reconciled(rows, imports.admit(told)[1])


@query(
    "far_view",
    with_(D.PLACES_SQL)
    + """, now AS (SELECT id, lng, lat, name, CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'MOVED' ELSE category END AS category, photo_url FROM places),
world AS (SELECT * FROM now WHERE category = 'BUILDING' ORDER BY id LIMIT 500),
box AS (SELECT * FROM now WHERE lng BETWEEN -100.5 AND 60 AND lat BETWEEN -45 AND 70.25 ORDER BY id LIMIT 500)
SELECT 'world' AS view, * FROM world UNION ALL SELECT 'box', * FROM box""",
)
def far_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the world and one of a box from a pyramid, after a third of the places have changed their category."""
    before, path = D.places(spark, sf_dir), scratch(spark, "pyramid")
    moved = before.where("CAST(id AS BIGINT) % 3 = 0").withColumn("category", F.lit("MOVED"))
    now = before.where("CAST(id AS BIGINT) % 3 != 0").unionByName(moved)
    pyramid.pyramid(before).write.partitionBy("level").parquet(f"{path}/before")
    tiles = pyramid.refreshed(spark.read.parquet(f"{path}/before"), now, moved)
    tiles.write.partitionBy("level").parquet(f"{path}/now")
    tiles = spark.read.parquet(f"{path}/now")
    world = pyramid.far_view(tiles, now, V.Box(-180, -90, 180, 90), 2, "BUILDING")
    box = pyramid.far_view(tiles, now, V.Box(-100.5, -45, 60, 70.25), 3)
    return world.select(F.lit("world").alias("view"), "*").unionByName(box.select(F.lit("box").alias("view"), "*"))
