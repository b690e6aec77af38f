"""Registered queries over the derived tables, and the SQL that checks each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import bag, text
from .operators import clusters as C, integrity, places as P, upsert, users as U, viewport as V
from .plans import imports, migrations
from .sources import derived as D
from .streaming.debounce import debounce_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- viewport ---------------------------------------------------------------------------


@query(
    "viewport",
    with_(D.PLACES_SQL)
    + "SELECT id, lng, lat, name, category, photo_url FROM places"
    " WHERE lng >= -60 AND lat >= -40 AND lng <= 60 AND lat <= 40 AND category = 'BUILDING' ORDER BY id LIMIT 5000",
)
def viewport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.viewport(D.places(spark, sf_dir), V.Box(-60, -40, 60, 40), 7, "BUILDING")


@query("viewport_world", with_(D.PLACES_SQL) + "SELECT id, lng, lat, name, category, photo_url FROM places ORDER BY id LIMIT 500")
def viewport_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wider than the world threshold: no spatial filter; far zoom: the small limit."""
    return V.viewport(D.places(spark, sf_dir), V.Box(-180, -85, 180, 85), 3)


@query(
    "viewport_not_quite_world",
    with_(D.PLACES_SQL)
    + "SELECT id, lng, lat, name, category, photo_url FROM places"
    " WHERE lng BETWEEN -150 AND 150 AND lat BETWEEN -80 AND 80 ORDER BY id LIMIT 5000",
)
def viewport_not_quite_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.viewport(D.places(spark, sf_dir), V.Box(-150, -80, 150, 80), 6)


COLLECTION_SQL = """SELECT 'FeatureCollection' AS type, count(*) AS n, coalesce(string_agg(id, ',' ORDER BY id), '') AS ids,
  count(photo_url) AS photos, coalesce(sum(lng + lat), 0.0) AS checksum FROM found"""


def flat_collection(found: DataFrame) -> DataFrame:
    f = F.col("features")
    at = lambda i: F.transform(f, lambda x: x["geometry"]["coordinates"][i])
    add = lambda a, x: a + x
    return V.collection(found).select(
        "type",
        F.size(f).cast("long").alias("n"),
        F.array_join(F.transform(f, lambda x: x["id"]), ",").alias("ids"),
        F.size(F.filter(f, lambda x: x["properties"]["photo_url"].isNotNull())).cast("long").alias("photos"),
        F.round(F.aggregate(at(0), F.lit(0.0), add) + F.aggregate(at(1), F.lit(0.0), add), 6).alias("checksum"),
    )


@query(
    "feature_collection",
    with_(D.PLACES_SQL, " found AS (SELECT * FROM places WHERE lng BETWEEN 0 AND 60 AND lat BETWEEN 0 AND 40 ORDER BY id LIMIT 5000)")
    + COLLECTION_SQL.replace("coalesce(sum(lng + lat), 0.0)", "round(coalesce(sum(lng + lat), 0.0), 6)"),
)
def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_collection(V.viewport(D.places(spark, sf_dir), V.Box(0, 0, 60, 40), 8))


@query(
    "feature_collection_empty",
    with_(D.PLACES_SQL, " found AS (SELECT * FROM places WHERE category = '')") + COLLECTION_SQL,
)
def feature_collection_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row with no features: the empty text is a category that no place has."""
    return flat_collection(V.viewport(D.places(spark, sf_dir), V.Box(0, 0, 60, 40), 8, ""))


@query("feature_json")
def feature_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as JSON text; its number format is the engine's own, so no SQL."""
    return V.as_json(V.collection(V.viewport(D.places(spark, sf_dir), V.Box(0, 0, 60, 40), 8)))


# --- places -----------------------------------------------------------------------------


@query(
    "place_detail",
    with_(D.PLACES_SQL)
    + "SELECT id, name, category, description, photo_url, address, website, hours, lng, lat, 'Point' AS point_type FROM places WHERE id = '42'",
)
def place_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.detail(D.places(spark, sf_dir), "42")
    return found.select(*P.DETAIL, F.col("geometry.type").alias("point_type"))


@query("place_detail_missing", "SELECT 'none' AS id, CAST(NULL AS VARCHAR) AS name")
def place_detail_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.detail(D.places(spark, sf_dir), "no-such-id").select("id", "name")
    return P.first_or(found, {"id": "none", "name": None})


@query("categories", with_(D.PLACES_SQL) + "SELECT DISTINCT category FROM places ORDER BY category")
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.categories(D.places(spark, sf_dir))


@query("category_list", with_(D.PLACES_SQL) + "SELECT string_agg(DISTINCT category, ',' ORDER BY category) AS categories FROM places")
def category_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.category_list(D.places(spark, sf_dir)).select(F.array_join("categories", ",").alias("categories"))


@query("place_count", with_(D.PLACES_SQL) + "SELECT CAST(count(*) AS INTEGER) AS n FROM places")
def place_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.count_rows(D.places(spark, sf_dir))


@query("guest_count", with_(D.USERS_SQL) + "SELECT CAST(count(*) AS INTEGER) AS n FROM users WHERE is_guest")
def guest_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.count_rows(D.users(spark, sf_dir), F.col("is_guest"))


@query(
    "category_histogram",
    with_(D.STAGED_SQL)
    + "SELECT category, count(*) AS n, min(idx) AS first_seen FROM staged GROUP BY category ORDER BY n DESC, first_seen",
)
def category_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.histogram(D.staged_imports(spark, sf_dir))


@query(
    "top_categories",
    with_(D.STAGED_SQL)
    + "SELECT category, count(*) AS n, min(idx) AS first_seen FROM staged GROUP BY category ORDER BY n DESC, first_seen LIMIT 3",
)
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.histogram(D.staged_imports(spark, sf_dir)).limit(3)


CLUSTERS_SQL = (
    with_(
        D.PLACES_SQL,
        """
placed AS (
  SELECT id, lng, lat, CAST(floor((lng + 180) / 360 * 2048.0 / 40) AS BIGINT) AS cell_x,
    CAST(floor((0.5 - ln(tan(radians(45 + greatest(-85.0511, least(85.0511, lat)) / 2))) / (2 * pi())) * 2048.0 / 40) AS BIGINT) AS cell_y
  FROM places),
cells AS (SELECT cell_x, cell_y, count(*) AS point_count, avg(lng) AS lng, avg(lat) AS lat FROM placed GROUP BY 1, 2)""",
    )
    + """
SELECT cell_x, cell_y, point_count, CAST(NULL AS VARCHAR) AS id, round(lng, 6) AS lng, round(lat, 6) AS lat,
  CASE WHEN point_count >= 1000 THEN 19 WHEN point_count >= 100 THEN 16 WHEN point_count >= 10 THEN 13 ELSE 10 END AS size
FROM cells WHERE point_count >= 3
UNION ALL
SELECT p.cell_x, p.cell_y, NULL, p.id, round(p.lng, 6), round(p.lat, 6), NULL FROM placed p JOIN cells c USING (cell_x, cell_y) WHERE c.point_count < 3"""
)


@query("clusters", CLUSTERS_SQL)
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.clusters(D.places(spark, sf_dir), 2)
    return out.withColumn("lng", F.round("lng", 6)).withColumn("lat", F.round("lat", 6))


@query("cluster_leaves", f"SELECT count(*) AS n FROM ({CLUSTERS_SQL}) WHERE point_count IS NULL")
def cluster_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.clusters(D.places(spark, sf_dir), 2).where("point_count IS NULL").agg(F.count("*").alias("n"))


def radius_clusters_sql(first: int, last: int) -> str:
    """The sweeps of all levels: nine steps each, as tables of their own, with leaders sought among all."""
    tables = [
        f"""n{first + 1} AS MATERIALIZED (SELECT id, {first + 1} AS zoom, 1 AS n, CAST(floor((lng + 180) / 360 * 2147483648) AS BIGINT) AS x,
  CAST(floor((0.5 - ln(tan(radians(45 + greatest(-85.0511, least(85.0511, lat)) / 2))) / (2 * pi())) * 2147483648) AS BIGINT) AS y FROM places)"""
    ]
    done = []
    for z in range(first, last - 1, -1):
        r = C.radius_at(z)
        side = C.isqrt(r * r // 2)
        tables.append(f"c{z} AS MATERIALIZED (SELECT *, x // {side} AS cx, y // {side} AS cy, (x // {side} % 3) * 3 + y // {side} % 3 AS colour FROM n{z + 1})")
        close = f"(p.x - l.x) * (p.x - l.x) + (p.y - l.y) * (p.y - l.y) <= {r * r}"
        before = []
        for k in range(C.COLOURS):
            free = f" AND NOT EXISTS (SELECT 1 FROM ({' UNION ALL '.join(before)}) l WHERE {close})" if before else ""
            lead = "arg_min(struct_pack(id := id, n := n, x := x, y := y), (-n, id))"
            tables.append(f"l{z}_{k} AS MATERIALIZED (SELECT {k} AS colour, l.* FROM (SELECT {lead} AS l FROM c{z} p WHERE colour = {k}{free} GROUP BY cx, cy))")
            before.append(f"SELECT * FROM l{z}_{k}")
        tables += [
            f"l{z} AS MATERIALIZED ({' UNION ALL '.join(before)})",
            f"t{z} AS MATERIALIZED (SELECT p.id, p.zoom, p.n, p.x, p.y, arg_min(l.id, (l.colour, -l.n, l.id)) AS leader FROM c{z} p JOIN l{z} l ON {close} GROUP BY ALL)",
            f"g{z} AS MATERIALIZED (SELECT leader, '{z}:' || leader AS id, sum(n) AS n, sum(n * x) // sum(n) AS x, sum(n * y) // sum(n) AS y FROM t{z} GROUP BY leader HAVING count(*) > 1 AND sum(n) >= 3)",
            f"n{z} AS MATERIALIZED (SELECT id, {z} AS zoom, n, x, y FROM g{z} UNION ALL SELECT id, zoom, n, x, y FROM t{z} WHERE leader NOT IN (SELECT leader FROM g{z}))",
        ]
        done.append(f"SELECT t.id, t.zoom, t.n, t.x, t.y, g.id AS parent_id FROM t{z} t JOIN g{z} g ON g.leader = t.leader")
    done.append(f"SELECT id, zoom, n, x, y, NULL FROM n{last}")
    rows = " UNION ALL ".join(done)
    return with_(D.PLACES_SQL, *tables) + f"SELECT id, CAST(zoom AS INTEGER) AS zoom, CAST(n AS BIGINT) AS n, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, parent_id FROM ({rows})"


@query("radius_clusters", radius_clusters_sql(10, 0))
def radius_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All levels at which the map clusters, as one tree."""
    return C.cluster_tree(D.places(spark, sf_dir))


@query(
    "category_order",
    """SELECT label, row_number() OVER (ORDER BY lower(strip_accents(label)), strip_accents(label) <> label, label DESC) AS place FROM (
  SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN lower(c_mktsegment) WHEN 2 THEN c_mktsegment[1] || lower(c_mktsegment[2:])
    ELSE replace(lower(c_mktsegment), 'u', 'ü') END AS label FROM customer)""",
)
def category_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories in four spellings, numbered in the order of the Unicode collation: accents after letters, upper case after lower."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    spelt = F.when(key % 4 == 0, segment).when(key % 4 == 1, F.lower(segment)).when(key % 4 == 2, F.initcap(segment))
    spelt = spelt.otherwise(F.replace(F.lower(segment), F.lit("u"), F.lit("ü")))
    return P.numbered_labels(D.table(spark, sf_dir, "customer").select(spelt.alias("label")), "label")


# --- users ------------------------------------------------------------------------------

FOLD_SQL = """
folded AS (
  SELECT user_id,
    arg_max(struct_pack(v := basemap_id), (ts, event_id)) FILTER (has_basemap) AS b,
    arg_max(struct_pack(lng := lng, lat := lat), (ts, event_id)) FILTER (has_center) AS c,
    arg_max(struct_pack(v := last_zoom), (ts, event_id)) FILTER (has_zoom) AS z, max(ts) AS updated_at
  FROM patches GROUP BY user_id),
preferences AS (
  SELECT user_id, b.v AS basemap_id, c.lng AS last_center_lng, c.lat AS last_center_lat, z.v AS last_zoom, updated_at FROM folded)"""


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.fold_preferences(D.preference_patches(spark, sf_dir))


@query("preferences", with_(D.PATCHES_SQL, FOLD_SQL) + "SELECT * FROM preferences")
def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folded(spark, sf_dir)


@query(
    "preference_history",
    with_(D.PATCHES_SQL)
    + """SELECT user_id, event_id,
  (last_value(CASE WHEN has_basemap THEN struct_pack(v := basemap_id) END IGNORE NULLS) OVER w).v AS basemap_id,
  (last_value(CASE WHEN has_center THEN struct_pack(v := lng) END IGNORE NULLS) OVER w).v AS lng,
  (last_value(CASE WHEN has_zoom THEN struct_pack(v := last_zoom) END IGNORE NULLS) OVER w).v AS last_zoom
FROM patches WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def preference_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = U.preference_history(D.preference_patches(spark, sf_dir))
    return out.select("user_id", "event_id", "basemap_id", F.get("last_center", F.lit(0)).alias("lng"), "last_zoom")


@query("user_tier", with_(D.USERS_SQL) + "SELECT tier FROM users WHERE id = '7'")
def user_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.tier_of(D.users(spark, sf_dir), "7")


@query("user_preferences", with_(D.PATCHES_SQL, FOLD_SQL) + "SELECT * FROM preferences WHERE user_id = '7'")
def user_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.preferences_of(folded(spark, sf_dir), "7")


@query(
    "sessions",
    with_(D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL)
    + f"""SELECT id AS user_id, display_name, tier, is_guest, basemap_id,
  CASE WHEN last_center_lng IS NOT NULL AND last_center_lat IS NOT NULL THEN last_center_lng END AS lng,
  CASE WHEN last_center_lng IS NOT NULL AND last_center_lat IS NOT NULL THEN last_center_lat END AS lat, last_zoom,
  CASE WHEN tier = 'premium' THEN '{",".join(U.FREE + U.EXTRAS)}' ELSE '{",".join(U.FREE)}' END AS providers
FROM users LEFT JOIN preferences ON user_id = id""",
)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = U.sessions(D.users(spark, sf_dir), folded(spark, sf_dir))
    p = "preferences"
    return out.select(
        F.col("userId").alias("user_id"),
        F.col("displayName").alias("display_name"),
        "tier",
        F.col("isGuest").alias("is_guest"),
        F.col(f"{p}.basemapId").alias("basemap_id"),
        F.get(f"{p}.lastCenter", F.lit(0)).alias("lng"),
        F.get(f"{p}.lastCenter", F.lit(1)).alias("lat"),
        F.col(f"{p}.lastZoom").alias("last_zoom"),
        F.array_join("allowedProviders", ",").alias("providers"),
    )


PROVIDERS_SQL = "providers(id, label, kind, tier, max_zoom) AS (VALUES " + ", ".join(map(str, U.PROVIDERS)) + ")"


def map_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a request for a basemap, some of which aren't registered."""
    names = F.array(*[F.lit(p[0]) for p in U.PROVIDERS], F.lit("gone"), F.lit("none"))
    asked = F.element_at(names, (F.col("event_id") * 7 % 15 + 1).cast("int"))
    return D.table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user_id"), asked.alias("provider_id"))


MAP_REQUESTS_SQL = f"requests AS (SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, ([{sql_list([p[0] for p in U.PROVIDERS] + ['gone', 'none'])}])[event_id * 7 % 15 + 1] AS provider_id FROM events)"


@query(
    "providers",
    with_(PROVIDERS_SQL, MAP_REQUESTS_SQL)
    + "SELECT p.*, count(event_id) AS n FROM providers p LEFT JOIN requests ON provider_id = id GROUP BY ALL",
)
def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry with the number of requests for each provider."""
    asked = map_requests(spark, sf_dir).groupBy(F.col("provider_id").alias("id")).agg(F.count("*").alias("n"))
    return U.registry(spark).join(asked, "id", "left").fillna(0, ["n"])


@query(
    "provider_fallback",
    with_(PROVIDERS_SQL, MAP_REQUESTS_SQL)
    + f"""SELECT event_id, p.id AS provider, p.label, p.max_zoom FROM requests r JOIN providers p
  ON p.id = CASE WHEN r.provider_id IN (SELECT id FROM providers) THEN r.provider_id ELSE '{U.DEFAULT_PROVIDER}' END""",
)
def provider_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = U.with_provider(map_requests(spark, sf_dir))
    return found.select("event_id", "provider", F.col("provider_label").alias("label"), F.col("provider_max_zoom").alias("max_zoom"))


@query(
    "providers_free",
    with_(PROVIDERS_SQL, MAP_REQUESTS_SQL) + "SELECT event_id, id, label FROM requests JOIN providers ON id = provider_id WHERE tier = 'free'",
)
def providers_free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for the providers of the free tier."""
    free = F.broadcast(U.registry(spark).where("tier = 'free'").select("id", "label"))
    return map_requests(spark, sf_dir).join(free, F.col("provider_id") == F.col("id")).select("event_id", "id", "label")


@query(
    "locked_providers",
    with_(D.USERS_SQL, PROVIDERS_SQL)
    + """SELECT t.tier, p.id, p.label, p.tier AS provider_tier, t.tier <> 'premium' AND p.tier = 'premium' AS locked
FROM (SELECT DISTINCT tier FROM users) t, providers p""",
)
def locked_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.locked_providers(spark, D.users(spark, sf_dir).select("tier").distinct())


@query(
    "usable_providers",
    with_(D.USERS_SQL, PROVIDERS_SQL, MAP_REQUESTS_SQL)
    + """SELECT event_id, provider_id FROM requests r JOIN users u ON u.id = r.user_id
WHERE provider_id IN (SELECT id FROM providers) AND (u.tier = 'premium' OR provider_id IN (SELECT id FROM providers WHERE tier = 'free'))""",
)
def usable_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of users for providers that are registered and that their tier may use: two semi joins."""
    tiers = D.users(spark, sf_dir).select(F.col("id").alias("user_id"), "tier")
    allowed = U.registry(spark).select("id").crossJoin(tiers.select("tier").distinct()).where(F.array_contains(U.allowed(F.col("tier")), F.col("id")))
    asked = map_requests(spark, sf_dir).join(tiers, "user_id").withColumnRenamed("provider_id", "id")
    return asked.join(F.broadcast(allowed), ["id", "tier"], "left_semi").select("event_id", F.col("id").alias("provider_id"))


@query(
    "allowed_providers",
    with_(D.USERS_SQL)
    + f"SELECT id AS user_id, unnest(CASE WHEN tier = 'premium' THEN [{sql_list(U.FREE + U.EXTRAS)}] ELSE [{sql_list(U.FREE)}] END) AS provider FROM users",
)
def allowed_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.users(spark, sf_dir).select(F.col("id").alias("user_id"), F.explode(U.allowed(F.col("tier"))).alias("provider"))


def basemap_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("id").cast("long")
    names = F.array(*[F.lit(p[0]) for p in U.PROVIDERS], F.lit("gone"))
    pick = lambda n, every: F.when(key % every > 0, F.element_at(names, (key * n % 14 + 1).cast("int")))
    return D.users(spark, sf_dir).select("id", "tier", pick(3, 2).alias("asked"), pick(5, 3).alias("stored"), pick(11, 5).alias("preferred"))


_NAMES = sql_list([p[0] for p in U.PROVIDERS] + ["gone"])
REQUESTS_SQL = (
    "asks AS (SELECT id, tier, "
    + ", ".join(
        f"CASE WHEN CAST(id AS BIGINT) % {every} > 0 THEN [{_NAMES}][CAST(id AS BIGINT) * {n} % 14 + 1] END AS {name}"
        for name, n, every in (("asked", 3, 2), ("stored", 5, 3), ("preferred", 11, 5))
    )
    + " FROM users)"
)


@query(
    "basemap_resolution",
    with_(D.USERS_SQL, REQUESTS_SQL)
    + "SELECT id, coalesce("
    + ", ".join(
        f"CASE WHEN {c} IN ({sql_list(U.FREE)}) OR tier = 'premium' AND {c} IN ({sql_list(U.EXTRAS)}) THEN {c} END"
        for c in ("asked", "stored", "preferred")
    )
    + f", '{U.DEFAULT_PROVIDER}') AS basemap FROM asks",
)
def basemap_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = basemap_requests(spark, sf_dir)
    chosen = U.resolve_basemap(*(F.col(c) for c in ("asked", "stored", "preferred", "tier")))
    return asks.select("id", chosen.alias("basemap"))


@query(
    "initial_view",
    with_(D.PATCHES_SQL, FOLD_SQL)
    + """SELECT user_id, CASE WHEN ok THEN last_center_lng ELSE 10.0 END AS lng, CASE WHEN ok THEN last_center_lat ELSE 20.0 END AS lat,
  CASE WHEN ok THEN last_zoom ELSE 2.0 END AS zoom
FROM (SELECT *, last_center_lng IS NOT NULL AND last_center_lat IS NOT NULL AND last_zoom IS NOT NULL AS ok FROM preferences)""",
)
def initial_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = folded(spark, sf_dir)
    view = U.initial_view(F.col("last_center_lng"), F.col("last_center_lat"), F.col("last_zoom"))
    return p.select("user_id", view.alias("v")).select(
        "user_id", F.get("v.center", F.lit(0)).alias("lng"), F.get("v.center", F.lit(1)).alias("lat"), F.col("v.zoom").alias("zoom")
    )


@query(
    "credentials_gate",
    with_(D.USERS_SQL, REQUESTS_SQL)
    + """SELECT id, asked AS provider_id, CASE WHEN tier <> 'premium' THEN 403 WHEN starts_with(asked, 'thunderforest-') THEN 200 ELSE 404 END AS status,
  CASE WHEN tier = 'premium' AND starts_with(asked, 'thunderforest-') THEN 'k1' END AS api_key FROM asks""",
)
def credentials_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = basemap_requests(spark, sf_dir).select("id", "tier", F.col("asked").alias("provider_id"))
    return U.credentials(asks, {"thunderforest": "k1", "stamen": ""}).drop("tier")


@query(
    "toggled_selection",
    """WITH clicks AS (SELECT user_id, ts, event_id, event_type AS place FROM events),
runs AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
  - row_number() OVER (PARTITION BY user_id, place ORDER BY ts, event_id) AS run FROM clicks)
SELECT user_id, event_id, CASE WHEN row_number() OVER (PARTITION BY user_id, place, run ORDER BY ts, event_id) % 2 = 1 THEN place END AS selected
FROM runs""",
)
def toggled_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = D.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("place"))
    return U.toggled(clicks).select("user_id", "event_id", "selected")


# --- imports ----------------------------------------------------------------------------

_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_BLANK = "coalesce(" + _TRIM + ", '') = ''"


def _text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _number_sql(c: str, low: int, high: int) -> str:
    before, after = imports.OUT_OF_RANGE
    return (
        f"CASE WHEN {c} IS NULL OR isnan({c}) THEN {_text_sql(imports.NO_NUMBER % c)} END,"
        f" CASE WHEN NOT isnan({c}) AND {c} NOT BETWEEN {low} AND {high} THEN {_text_sql(before % c)}"
        f" || CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END || {_text_sql(after % (low, high))} END"
    )


VALID_SQL = f"""
validated AS (
  SELECT *, idx // 500 AS chunk, list_filter([
    CASE WHEN {_BLANK.format("name")} THEN {_text_sql(imports.NO_NAME)} END,
    CASE WHEN {_BLANK.format("category")} THEN {_text_sql(imports.NO_CATEGORY)} END,
    {_number_sql("lng", -180, 180)}, {_number_sql("lat", -90, 90)}], lambda x: x IS NOT NULL) AS errors
  FROM staged),
cleaned AS (
  SELECT idx, {_TRIM.format("name")} AS name, {_TRIM.format("category")} AS category,
    {", ".join(f"nullif({_TRIM.format(c)}, '') AS {c}" for c in ("description", "photo_url", "address", "website", "hours"))}, lng, lat
  FROM validated WHERE len(errors) = 0)"""


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.validate(D.staged_imports(spark, sf_dir))


@query(
    "import_rejected",
    with_(D.STAGED_SQL, VALID_SQL) + "SELECT idx, chunk, name, array_to_string(errors, '; ') AS message FROM validated WHERE len(errors) > 0",
)
def import_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.rejected(validated(spark, sf_dir))


@query(
    "import_first_rejected",
    with_(D.STAGED_SQL, VALID_SQL)
    + "SELECT idx, chunk, name, array_to_string(errors, '; ') AS message FROM validated WHERE len(errors) > 0 ORDER BY idx LIMIT 20",
)
def import_first_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.first_rejected(validated(spark, sf_dir))


@query("import_cleaned", with_(D.STAGED_SQL, VALID_SQL) + "SELECT * FROM cleaned")
def import_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.clean(validated(spark, sf_dir))


@query("import_dry_run", with_(D.STAGED_SQL, VALID_SQL) + "SELECT * FROM cleaned ORDER BY idx LIMIT 3")
def import_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.dry_run(imports.clean(validated(spark, sf_dir)))


@query(
    "import_summary",
    with_(D.STAGED_SQL, VALID_SQL)
    + """SELECT count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (len(errors) > 0) AS invalid,
  count(*) FILTER (len(errors) = 0) AS inserted, CAST(0 AS BIGINT) AS failed, true AS success FROM validated""",
)
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.summary(validated(spark, sf_dir))


@query(
    "import_chunks",
    with_(D.STAGED_SQL, VALID_SQL) + "SELECT chunk, count(*) AS n, count(*) FILTER (len(errors) > 0) AS bad FROM validated GROUP BY chunk",
)
def import_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).groupBy("chunk").agg(F.count("*").alias("n"), F.count_if(F.size("errors") > 0).alias("bad"))


_VALUES = ["name", "category", "description", "photo_url", "address", "website", "hours"]
LWW_SQL = """
fresh AS (SELECT * EXCLUDE (rn, idx) FROM (SELECT *, row_number() OVER (PARTITION BY lng, lat ORDER BY idx DESC) AS rn FROM cleaned) WHERE rn = 1)"""


@query("last_write_wins", with_(D.STAGED_SQL, VALID_SQL, LWW_SQL) + "SELECT * FROM fresh")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = imports.clean(validated(spark, sf_dir))
    return upsert.last_write_wins(cleaned, ["lng", "lat"], ["idx"]).drop("idx")


def moved_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places and, as rows present before an import, an earlier state of some of its keys."""
    cleaned = imports.clean(validated(spark, sf_dir)).where("idx % 2 = 0")
    before = upsert.last_write_wins(cleaned, ["lng", "lat"], ["idx"])
    known = before.select(
        F.concat(F.lit("old-"), F.col("idx").cast("string")).alias("id"),
        "name",
        "category",
        F.lit("before").alias("description"),
        F.lit("before").alias("photo_url"),
        "address",
        "website",
        "hours",
        "lng",
        "lat",
        F.timestamp_seconds(D.START + F.col("idx")).alias("created_at"),
    )
    return known.where("idx % 3 = 0") if "idx" in known.columns else known.where(F.col("created_at").cast("long") % 3 == 0)


@query(
    "upsert_places",
    with_(
        D.STAGED_SQL,
        VALID_SQL,
        LWW_SQL,
        f"""
before AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lng, lat ORDER BY idx DESC) AS rn FROM cleaned WHERE idx % 2 = 0)
  WHERE rn = 1 AND ({D.START} + idx) % 3 = 0),
source AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lng, lat ORDER BY idx DESC) AS rn FROM cleaned WHERE category <> 'view') WHERE rn = 1)""",
    )
    + """SELECT lng, lat, CASE WHEN b.idx IS NOT NULL THEN 'old-' || b.idx ELSE 'new' END AS id,
  CASE WHEN b.idx IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(b.idx) END AS created_at,
  CASE WHEN s.idx IS NOT NULL THEN s.name ELSE b.name END AS name,
  CASE WHEN s.idx IS NOT NULL THEN s.category ELSE b.category END AS category,
  CASE WHEN s.idx IS NOT NULL THEN s.description ELSE 'before' END AS description,
  CASE WHEN s.idx IS NOT NULL THEN s.photo_url ELSE 'before' END AS photo_url,
  CASE WHEN s.idx IS NOT NULL THEN s.website ELSE b.website END AS website
FROM before b FULL JOIN source s USING (lng, lat)""",
)
def upsert_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = imports.clean(validated(spark, sf_dir)).where("category <> 'view'")
    out = upsert.upsert_places(moved_places(spark, sf_dir), source)
    old = F.startswith(F.col("id"), F.lit("old-"))
    return out.select(
        "lng",
        "lat",
        F.when(old, F.col("id")).otherwise("new").alias("id"),
        F.when(old, F.col("created_at")).alias("created_at"),
        *["name", "category", "description", "photo_url", "website"],
    )


@query("replace_places", with_(D.STAGED_SQL, VALID_SQL, LWW_SQL) + f"SELECT {', '.join(_VALUES)}, lng, lat FROM fresh")
def replace_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace mode: the target is emptied first."""
    target = moved_places(spark, sf_dir).limit(0)
    return upsert.upsert_places(target, imports.clean(validated(spark, sf_dir))).drop("id", "created_at")


@query(
    "upsert_preferences",
    with_(D.PATCHES_SQL, FOLD_SQL)
    + """SELECT user_id, CASE WHEN hit THEN 'fresh' ELSE basemap_id END AS basemap_id, CASE WHEN hit THEN NULL ELSE last_center_lng END AS last_center_lng,
  CASE WHEN hit THEN NULL ELSE last_center_lat END AS last_center_lat, CASE WHEN hit THEN 1.0 ELSE last_zoom END AS last_zoom
FROM (SELECT *, CAST(user_id AS BIGINT) % 4 = 0 AS hit FROM preferences) UNION ALL SELECT 'someone', 'fresh', NULL, NULL, 1.0""",
)
def upsert_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = folded(spark, sf_dir)
    ids = target.where(F.col("user_id").cast("long") % 4 == 0).select("user_id")
    ids = ids.union(spark.createDataFrame([("someone",)], "user_id string"))
    empty = F.lit(None).cast("double")
    source = ids.select(
        "user_id",
        F.lit("fresh").alias("basemap_id"),
        empty.alias("last_center_lng"),
        empty.alias("last_center_lat"),
        F.lit(1.0).alias("last_zoom"),
    )
    return upsert.upsert_preferences(target, source).drop("updated_at")


@query(
    "insert_or_ignore",
    with_(D.MIGRATIONS_SQL)
    + "SELECT filename, checksum FROM ledger UNION ALL SELECT filename, sha256(sql) FROM migrations WHERE filename NOT IN (SELECT filename FROM ledger)",
)
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    noted = migrations.with_checksums(D.migrations(spark, sf_dir)).select("filename", "checksum")
    return upsert.insert_or_ignore(D.ledger(spark, sf_dir), noted, ["filename"])


@query("plain_insert_conflicts", with_(D.PLACES_SQL) + "SELECT lng, lat, count(*) + 1 AS n FROM places WHERE category = 'BUILDING' GROUP BY lng, lat")
def plain_insert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that would be there twice if the BUILDING places were inserted again."""
    every = D.places(spark, sf_dir)
    return upsert.plain_insert(every, every.where("category = 'BUILDING'"), ["lng", "lat"])[1]


VISITS_SQL = "visits AS (SELECT event_id, user_id, event_type, date_trunc('day', ts) AS created_at FROM events)"


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("created_at"))


NEWEST_SQL = (
    with_(VISITS_SQL)
    + """SELECT a.* FROM visits a WHERE NOT EXISTS (SELECT 1 FROM visits b WHERE b.user_id = a.user_id AND b.event_type = a.event_type
  AND a.created_at < b.created_at)"""
)


@query("newest_per_key", NEWEST_SQL)
def newest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are coarse, so equal times occur, and all of them stay."""
    return upsert.newest_per_key(visits(spark, sf_dir), ["user_id", "event_type"])


@query("newest_by_rank", NEWEST_SQL)
def newest_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.newest_by_rank(visits(spark, sf_dir), ["user_id", "event_type"])


# --- migrations, integrity, catalog -----------------------------------------------------


@query(
    "pending_migrations",
    with_(D.MIGRATIONS_SQL)
    + "SELECT filename, sha256(sql) AS checksum FROM migrations WHERE filename NOT IN (SELECT filename FROM ledger) ORDER BY filename",
)
def pending_migrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return migrations.pending(D.migrations(spark, sf_dir), D.ledger(spark, sf_dir)).select("filename", "checksum")


@query(
    "changed_migrations",
    with_(D.MIGRATIONS_SQL)
    + "SELECT filename, sha256(sql) AS checksum, l.checksum AS applied_checksum FROM migrations JOIN ledger l USING (filename) WHERE sha256(sql) <> l.checksum",
)
def changed_migrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return migrations.changed(D.migrations(spark, sf_dir), D.ledger(spark, sf_dir))


@query(
    "executable_sql",
    with_(D.MIGRATIONS_SQL)
    + r"SELECT filename, array_to_string(list_filter(string_split(sql, chr(10)), lambda x: NOT starts_with(x, '\')), chr(10)) AS executable, true AS transactional FROM migrations",
)
def executable_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return migrations.with_checksums(D.migrations(spark, sf_dir)).select("filename", "executable", "transactional")


@query("latest_version", "SELECT max(p_partkey % 40) || '.' || max(p_partkey % 7) AS latest FROM (SELECT * FROM part WHERE p_partkey % 40 = (SELECT max(p_partkey % 40) FROM part))")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    versions = D.table(spark, sf_dir, "part").select(F.concat_ws(".", key % 40, key % 7).alias("version"))
    return migrations.latest_version(versions)


@query(
    "migration_names",
    r"""SELECT p_partkey AS key, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey * 61), '%Y%m%d%H%M') || '__'
  || regexp_replace(regexp_replace(lower(' ' || p_name || ' & ' || p_brand || '!'), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') || '.sql' AS filename
FROM part""",
)
def migration_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.lit(" "), F.col("p_name"), F.lit(" & "), F.col("p_brand"), F.lit("!"))
    name = migrations.new_filename(title, F.timestamp_seconds(D.START + F.col("p_partkey") * 61))
    return D.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), name.alias("filename"))


@query("orphan_preferences", with_(D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL) + "SELECT user_id FROM preferences WHERE user_id NOT IN (SELECT id FROM users)")
def orphan_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.orphans(folded(spark, sf_dir), D.users(spark, sf_dir), "user_id", "id").select("user_id")


@query(
    "cascade_delete",
    with_(D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL) + "SELECT user_id, last_zoom FROM preferences WHERE user_id IN (SELECT id FROM users WHERE tier = 'free')",
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferences that stay when premium users are deleted."""
    left = D.users(spark, sf_dir).where("tier = 'free'")
    return integrity.cascade(folded(spark, sf_dir), left, "user_id", "id").select("user_id", "last_zoom")


@query(
    "integrity_report",
    with_(D.PLACES_SQL, D.USERS_SQL, D.PATCHES_SQL, FOLD_SQL)
    + """SELECT 'places_key' AS invariant, count(*) AS n FROM (SELECT 1 FROM places GROUP BY lng, lat HAVING count(*) > 1)
UNION ALL SELECT 'places_id', count(*) FROM (SELECT 1 FROM places GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'users_tier', count(*) FROM users WHERE tier NOT IN ('free', 'premium')
UNION ALL SELECT 'preferences_user', count(*) FROM preferences WHERE user_id NOT IN (SELECT id FROM users)""",
)
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.report(D.places(spark, sf_dir), D.users(spark, sf_dir), folded(spark, sf_dir))


GIVEN = ["customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier"]


def given_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of given tables, as their files have them."""
    return integrity.columns_of({t: D.table(spark, sf_dir, t).schema for t in GIVEN}, spark)


GIVEN_SQL = f"given AS (SELECT * FROM information_schema.columns WHERE table_name IN ({sql_list(GIVEN)}))"


@query(
    "missing_columns",
    with_(GIVEN_SQL)
    + """SELECT lower(n_name) AS table_name, column_name FROM nation, (SELECT DISTINCT column_name FROM given WHERE table_name = 'region') WHERE n_regionkey = 2
UNION ALL SELECT 'region', 'r_area'""",
)
def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract asks for more than there is: a column of region, and a table like it for each nation of a region."""
    present = given_columns(spark, sf_dir)
    own = present.where("table_name = 'region'").select("column_name")
    nations = D.table(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.lower("n_name").alias("table_name"))
    area = spark.range(1).select(F.lit("region").alias("table_name"), F.lit("r_area").alias("column_name"))
    expected = present.select("table_name", "column_name").union(nations.crossJoin(F.broadcast(own))).union(area)  # a row a column of a contract
    return integrity.missing_columns(expected, present)


@query("column_lists", with_(GIVEN_SQL) + "SELECT table_name, string_agg(column_name, ',' ORDER BY ordinal_position) AS columns FROM given GROUP BY table_name")
def column_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = given_columns(spark, sf_dir)
    return integrity.column_lists(columns.where((F.col("table_name") != "ledger") & F.col("table_name").isin(GIVEN)))


@query(
    "enum_labels",
    """SELECT n_name AS type_name, c_custkey AS sort_order, c_name AS label FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'""",
)
def enum_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = D.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("type_id"), F.col("c_custkey").alias("sort_order"), F.col("c_name").alias("label"))
    types = D.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("type_id"), F.col("n_name").alias("type_name"), F.col("n_regionkey").alias("namespace_id"))
    spaces = D.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("namespace_id"), F.col("r_name").alias("namespace"))
    return integrity.enum_labels(types, labels, spaces, "ASIA")


@query(
    "type_names",
    with_(GIVEN_SQL)
    + """SELECT table_name, column_name, CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT') OR data_type LIKE 'DECIMAL%' THEN 'number'
  WHEN data_type = 'BOOLEAN' THEN 'boolean' WHEN data_type = 'VARCHAR' THEN 'string' WHEN data_type = 'DATE' OR data_type LIKE 'TIMESTAMP%' THEN 'Date'
  WHEN data_type = 'FLOAT[]' THEN 'Array<number>' ELSE 'unknown' END AS type_name FROM given""",
)
def type_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = given_columns(spark, sf_dir).withColumn("udt", integrity.udt("data_type"))
    return named.select("table_name", "column_name", integrity.type_name("udt").alias("type_name"))


@query(
    "catalog_filters",
    r"SELECT p_partkey AS key FROM part WHERE p_type <> 'ECONOMY' AND p_name NOT LIKE 'red\_%' ESCAPE '\' AND p_size IN (1, 2, 3, 4)",
)
def catalog_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = D.table(spark, sf_dir, "part")
    kept = (F.col("p_type") != "ECONOMY") & ~F.col("p_name").like(r"red\_%") & F.col("p_size").isin(1, 2, 3, 4)
    return part.where(kept).select(F.col("p_partkey").alias("key"))


# --- text -------------------------------------------------------------------------------


@query(
    "html_text",
    r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS plain,
  regexp_matches(html, '(?i)<a\b') AS has_anchor, nullif(regexp_extract(html, 'https?://[^\s<>"]+'), '') AS first_url,
  regexp_replace(url, '^https?://(www\.)?', '') AS url_label, regexp_extract(url, '^[a-z]+://(?:[^@/]*@)?([^:/?]+)', 1) AS host
FROM pages""",
)
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    html, url = F.col("html"), F.col("url")
    return D.table(spark, sf_dir, "pages").select(
        "page_id",
        text.html_to_text(html).alias("plain"),
        text.has_anchor(html).alias("has_anchor"),
        text.first_url(html).alias("first_url"),
        text.url_label(url).alias("url_label"),
        text.host(url).alias("host"),
    )


@query(
    "escaped_html",
    """SELECT page_id, md5(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS escaped,
  md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;')) AS attribute FROM pages""",
)
def escaped_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return D.table(spark, sf_dir, "pages").select(
        "page_id", F.md5(text.escape_html(html)).alias("escaped"), F.md5(text.escape_attribute(html)).alias("attribute")
    )


@query("descriptions")
def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions prepared and sanitised for display; checked by tests, since SQL engines differ in lookaround."""
    pages = D.table(spark, sf_dir, "pages").select("page_id", F.concat_ws(" ", F.lit("see"), "url", F.lit("&")).alias("plain"), "html")
    return pages.select(
        "page_id", text.prepare_description(F.col("plain")).alias("linked"), F.md5(text.sanitise(F.col("html"))).alias("sanitised")
    )


@query(
    "coordinates",
    with_(D.STAGED_SQL)
    + """SELECT idx, lat_ok AND lng_ok AS ok, CASE WHEN lat_ok AND lng_ok THEN g END AS lng, CASE WHEN lat_ok AND lng_ok THEN t END AS lat
FROM (SELECT idx, g, t, g BETWEEN -180 AND 180 AS lng_ok, t BETWEEN -90 AND 90 AS lat_ok FROM (
  SELECT event_id AS idx, CAST(event_id % 400 - 200 AS DOUBLE) AS g, CAST(event_id % 190 - 95 AS DOUBLE) + 0.5 AS t FROM events))""",
)
def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    written = F.concat(F.lit(" \n"), (n % 400 - 200).cast("string"), F.lit("abc, "), (n % 190 - 95 + F.lit(0.5)).cast("double").cast("string"), F.lit("x,12\t"))
    parsed = D.table(spark, sf_dir, "events").select(n.alias("idx"), text.parse_coordinates(written).alias("p"))
    return parsed.select("idx", F.col("p").isNotNull().alias("ok"), F.col("p.lng").alias("lng"), F.col("p.lat").alias("lat"))


@query(
    "small_texts",
    r"""SELECT p_partkey AS key, strip AS stripped, upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) || upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2) AS pascal,
  split_part(p_type || '-' || p_size, '-', 1) AS base, 'https://x.example.com/a' AS bare, 'https://x.example.com/a/b/' AS path,
  CAST(floor(p_retailprice - p_partkey + 0.5) AS BIGINT) AS rounded, CAST(p_size AS INTEGER) AS major, printf('%.4f, %.4f', CAST(p_size AS DOUBLE), CAST(p_partkey AS DOUBLE)) AS fixed
FROM (SELECT *, p_name AS strip FROM part)""",
)
def small_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, size = F.col("p_name"), F.col("p_size")
    bare = F.lit("https://x.example.com/a//")
    return D.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("key"),
        text.strip_cdata(F.concat(F.lit("<![CDATA["), name, F.lit("]]>"))).alias("stripped"),
        text.pascal_case(F.concat(F.lit("--"), F.replace(name, F.lit(" "), F.lit("_")), F.lit("!"))).alias("pascal"),
        text.before_dash(F.concat(F.col("p_type"), F.lit("-"), size.cast("string"))).alias("base"),
        text.strip_slashes(bare).alias("bare"),
        text.join_path(bare, F.lit("/b/")).alias("path"),
        text.round_half_up(F.col("p_retailprice") - F.col("p_partkey")).alias("rounded"),
        text.major_version(F.concat(F.lit("tool "), size.cast("string"), F.lit(".4.1"))).alias("major"),
        text.fixed4(size.cast("double"), F.col("p_partkey").cast("double")).alias("fixed"),
    )


@query(
    "bags",
    """SELECT s_suppkey AS key,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Line' || chr(10) || 'two' ELSE 'Site URL: ' || u || chr(10) || 'Location City: ' || c || chr(10) || 'Location State: ' || n || chr(10) || 'Mail Address: ' || a END AS description,
  CASE WHEN starts_with(u, 'http') THEN u WHEN s_suppkey % 3 = 0 THEN 'https://raw.example.com/x,' END AS website,
  coalesce(nullif(concat_ws(', ', nullif(c, ''), nullif(n, '')), ''), a) AS address
FROM (SELECT *, CASE WHEN s_suppkey % 2 = 0 THEN 'http://s.example.com/' || s_suppkey ELSE 'none' END AS u,
  CASE WHEN s_suppkey % 5 < 2 THEN '' ELSE s_name END AS c, CASE WHEN s_suppkey % 5 < 1 THEN '' ELSE 'N' || s_nationkey END AS n, 'Box ' || s_suppkey AS a FROM supplier)""",
)
def bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    entry = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    fields = F.array(
        entry("Site URL", F.when(key % 2 == 0, F.concat(F.lit("http://s.example.com/"), key.cast("string"))).otherwise("none")),
        entry("Location City", F.lit("overwritten")),
        entry("Location Latitude", F.lit("1.5")),
        entry("Location City", F.when(key % 5 < 2, "").otherwise(F.col("s_name"))),
        entry("Location State", F.when(key % 5 < 1, "").otherwise(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")))),
        entry("", F.lit("nameless")),
        entry("Mail Address", F.concat(F.lit("Box "), key.cast("string"))),
    )
    raw = F.when(key % 3 == 0, "<b>Line</b><BR/>two <https://raw.example.com/x,>").otherwise("")
    tidied = bag.tidy(fields)
    return D.table(spark, sf_dir, "supplier").select(
        key.alias("key"),
        bag.description(raw, tidied).alias("description"),
        bag.website(tidied, raw).alias("website"),
        bag.address(tidied).alias("address"),
    )


# --- debounce ---------------------------------------------------------------------------


def debounce_sql(interval: str) -> str:
    return f"""WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL '{interval}' THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM marked)
SELECT user_id, max(ts) AS last_ts, count(*) AS n, arg_max(value, (ts, event_id)) AS value FROM runs GROUP BY user_id, run"""


@query("debounce_fetch", debounce_sql("1 hour"))
def debounce_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gap is an hour here: events lie minutes apart."""
    return debounce_table(D.table(spark, sf_dir, "events"), "1 hour", tie="event_id")


@query("debounce_save", debounce_sql("2 seconds"))
def debounce_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debounce_table(D.table(spark, sf_dir, "events"), "2 seconds", tie="event_id")


from . import queries_files, queries_requests  # noqa: E402, F401  register their queries
