"""Users, preferences, basemaps and what a tier may use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scan import running_last, with_runs

# The basemap registry (id, label, kind, tier, max_zoom).
PROVIDERS = [
    ("openfreemap-liberty", "OpenFreeMap Liberty", "vector", "free", 19),
    ("openfreemap-positron", "OpenFreeMap Positron", "vector", "free", 19),
    ("openfreemap-bright", "OpenFreeMap Bright", "vector", "free", 19),
    ("stadia-outdoors", "Stadia Outdoors", "vector", "free", 20),
    ("stamen-terrain", "Stamen Terrain", "vector", "free", 18),
    ("alidade-satellite", "Alidade Satellite", "vector", "free", 20),
    ("alidade-smooth", "Alidade Smooth", "vector", "free", 20),
    ("carto-voyager", "CARTO Voyager", "vector", "free", 20),
    ("carto-positron", "CARTO Positron", "vector", "free", 20),
    ("carto-dark-matter", "CARTO Dark Matter", "vector", "free", 20),
    ("opentopomap", "OpenTopoMap", "raster", "free", 17),
    ("thunderforest-outdoors", "Thunderforest Outdoors", "raster", "premium", 22),
    ("thunderforest-landscape", "Thunderforest Landscape", "raster", "premium", 22),
]
DEFAULT_PROVIDER = "openfreemap-liberty"
FREE = [p[0] for p in PROVIDERS if p[3] == "free"]
EXTRAS = [p[0] for p in PROVIDERS if p[3] == "premium"]
#: Where the map opens.
CENTER, ZOOM = (10.0, 20.0), 2.0


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROVIDERS, "id string, label string, kind string, tier string, max_zoom int")


def get_provider(spark: SparkSession, id: str) -> DataFrame:
    """The provider of an id, or the default one."""
    wanted = F.when(F.col("id") == id, 0).when(F.col("id") == DEFAULT_PROVIDER, 1)
    return registry(spark).withColumn("rank", wanted).where("rank IS NOT NULL").orderBy("rank").limit(1).drop("rank")


def with_provider(requests: DataFrame, id: str = "provider_id") -> DataFrame:
    """Requests with the columns of their provider, or of the default one where the id is no provider's. The registry is broadcast."""
    named = F.broadcast(registry(requests.sparkSession).select(*[F.col(c).alias(f"provider_{c}") for c in ("label", "kind", "tier", "max_zoom")], F.col("id").alias("_id")))
    known = F.array(*[F.lit(p[0]) for p in PROVIDERS])
    meant = F.when(F.array_contains(known, F.col(id)), F.col(id)).otherwise(DEFAULT_PROVIDER)
    return requests.withColumn("provider", meant).join(named, F.col("provider") == F.col("_id")).drop("_id")


def allowed(tier: Column) -> Column:
    """Provider ids by tier: any other tier than premium gets the free ones."""
    lists = [F.array(*map(F.lit, ids)) for ids in (FREE, EXTRAS)]
    return F.when(tier == "premium", F.concat(*lists)).otherwise(lists[0])


def center(lng: Column, lat: Column) -> Column:
    """[lng, lat] if both are there, else null."""
    return F.when(lng.isNotNull() & lat.isNotNull(), F.array(lng, lat))


def sessions(users: DataFrame, preferences: DataFrame) -> DataFrame:
    """Each user with nested preferences (null where there are none) and allowed providers."""
    p = preferences.withColumnRenamed("user_id", "p_user")
    return users.join(p, users.id == p.p_user, "left").select(
        F.col("id").alias("userId"),
        F.col("display_name").alias("displayName"),
        "tier",
        F.col("is_guest").alias("isGuest"),
        F.struct(
            F.col("basemap_id").alias("basemapId"),
            center(F.col("last_center_lng"), F.col("last_center_lat")).alias("lastCenter"),
            F.col("last_zoom").alias("lastZoom"),
        ).alias("preferences"),
        allowed(F.col("tier")).alias("allowedProviders"),
    )


def tier_of(users: DataFrame, user_id: str) -> DataFrame:
    return users.where(F.col("id") == user_id).select("tier")


def preferences_of(preferences: DataFrame, user_id: str) -> DataFrame:
    return preferences.where(F.col("user_id") == user_id)


def locked_providers(spark: SparkSession, tiers: DataFrame) -> DataFrame:
    """Every (tier, provider) with a flag. ``tiers`` holds a few distinct tiers."""
    pairs = tiers.select("tier", F.explode(allowed(F.col("tier"))).alias("id"))
    listed = registry(spark).select("id", "label", F.col("tier").alias("provider_tier"))
    ranked = tiers.select("tier", F.explode(F.array(*[F.lit(p[0]) for p in PROVIDERS])).alias("id")).join(F.broadcast(listed), "id")
    return ranked.join(pairs.withColumn("open", F.lit(True)), ["tier", "id"], "left").select(
        "tier", "id", "label", "provider_tier", F.col("open").isNull().alias("locked")
    )


def usable_providers(spark: SparkSession, tier: str) -> DataFrame:
    """Registered providers that a tier may use: a semi join."""
    own = spark.range(1).select(F.explode(allowed(F.lit(tier))).alias("id"))
    return registry(spark).join(F.broadcast(own), "id", "left_semi")


def resolve_basemap(asked: Column, stored: Column, preferred: Column, tier: Column) -> Column:
    """The first of address, local store and preference that is registered and allowed, else the default."""
    registered = F.array(*[F.lit(p[0]) for p in PROVIDERS])
    usable = F.array_intersect(registered, allowed(tier))
    valid = [F.when(F.array_contains(usable, c), c) for c in (asked, stored, preferred)]
    return F.coalesce(*valid, F.lit(DEFAULT_PROVIDER))


def initial_view(lng: Column, lat: Column, zoom: Column) -> Column:
    """struct<center,zoom>: the stored ones only if all are there."""
    stored = center(lng, lat).isNotNull() & zoom.isNotNull()
    return F.when(stored, F.struct(F.array(lng, lat).alias("center"), zoom.alias("zoom"))).otherwise(
        F.struct(F.array(*map(F.lit, CENTER)).alias("center"), F.lit(ZOOM).alias("zoom"))
    )


def credentials(requests: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Requests (provider_id, tier, ...) with status and api_key: 403 unless premium, 404 without a key, else 200."""
    lookup = F.create_map(*[F.lit(x) for pair in keys.items() for x in pair]) if keys else F.create_map().cast("map<string,string>")
    key = F.nullif(F.try_element_at(lookup, F.substring_index("provider_id", "-", 1)), F.lit(""))
    status = F.when(~F.col("tier").eqNullSafe(F.lit("premium")), 403).when(key.isNull(), 404).otherwise(200)
    return requests.withColumn("status", status).withColumn("api_key", F.when(F.col("status") == 200, key))


def fold_preferences(patches: DataFrame) -> DataFrame:
    """An ordered log of patches folded to one row a user.

    A field present in a patch replaces the former value, and an explicit null clears
    it; the center alone is replaced only by an array, so its null clears nothing. max_by keeps
    one value a user and field, so the fold is a partial aggregation, without a window.
    """
    order = F.struct("ts", "event_id")

    def latest(present: Column, value: Column) -> Column:
        return F.max_by(F.struct(value.alias("v")), F.when(present, order))["v"]

    found = patches.groupBy("user_id").agg(
        latest(F.col("has_basemap"), F.col("basemap_id")).alias("basemap_id"),
        latest(F.col("last_center").isNotNull(), F.col("last_center")).alias("center"),
        latest(F.col("has_zoom"), F.col("last_zoom")).alias("last_zoom"),
        F.max("ts").alias("updated_at"),
    )
    return found.select(
        "user_id",
        "basemap_id",
        F.get("center", F.lit(0)).alias("last_center_lng"),
        F.get("center", F.lit(1)).alias("last_center_lat"),
        "last_zoom",
        "updated_at",
    )


def preference_history(patches: DataFrame, parts: int | None = None) -> DataFrame:
    """The state after every patch: the running form of ``fold_preferences``. A user with most patches is split (``scan``)."""
    present = {
        "basemap": F.when(F.col("has_basemap"), F.struct(F.col("basemap_id").alias("v"))),
        "center": F.when(F.col("last_center").isNotNull(), F.struct(F.col("last_center").alias("v"))),
        "zoom": F.when(F.col("has_zoom"), F.struct(F.col("last_zoom").alias("v"))),
    }
    rows = patches.select("user_id", "ts", "event_id", *[F.coalesce(c, F.lit(None)).alias(f"_{n}") for n, c in present.items()])
    out = running_last(rows, "user_id", ["ts", "event_id"], {n: F.col(f"_{n}") for n in present}, parts)
    return out.select(
        "user_id",
        "event_id",
        F.col("basemap.v").alias("basemap_id"),
        F.col("center.v").alias("last_center"),
        F.col("zoom.v").alias("last_zoom"),
    )


def toggled(selections: DataFrame, parts: int | None = None) -> DataFrame:
    """The selected id after each click (user_id, ts, event_id, place): the same place again deselects.

    Inside a run of clicks on one place the odd ones select it. A user with most clicks is split (``scan``).
    """
    other = ~F.col("place").eqNullSafe(F.col("_last"))
    runs = with_runs(selections, "user_id", ["ts", "event_id"], F.col("place"), other, parts)
    return runs.withColumn("selected", F.when(F.col("_nth") % 2 == 1, F.col("place"))).drop("_run", "_nth")
