"""The application's requests, each as one plan over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import places as P
from ..operators import users as U
from ..operators import viewport as V
from ..operators.upsert import upsert_preferences


def get_places(places: DataFrame, bbox: str | None, zoom: str | None = None, category: str | None = None) -> DataFrame:
    """The feature collection of a view as one JSON row; raises BadRequest as the route answers 400."""
    box = V.parse_box(bbox)
    return V.as_json(V.collection(V.viewport(places, box, V.parse_zoom(zoom), category)))


def get_place(places: DataFrame, id: str) -> DataFrame:
    """One row, or none for status 404."""
    return P.detail(places, id)


def get_categories(places: DataFrame) -> DataFrame:
    return P.category_list(places)


def get_me(users: DataFrame, preferences: DataFrame, user_id: str = "guest") -> DataFrame:
    return U.sessions(users.where(F.col("id") == user_id), preferences)


def patch_preferences(preferences: DataFrame, user_id: str, patch: dict) -> DataFrame:
    """The preference table after a patch {basemapId?, lastCenter?, lastZoom?} of one user."""
    spark = preferences.sparkSession
    now = spark.range(1).select(F.lit(user_id).alias("user_id")).join(
        preferences.where(F.col("user_id") == user_id), "user_id", "left"
    )
    if "basemapId" in patch:
        now = now.withColumn("basemap_id", F.lit(patch["basemapId"]).cast("string"))
    if isinstance(patch.get("lastCenter"), (list, tuple)):
        lng, lat = patch["lastCenter"]
        now = now.withColumn("last_center_lng", F.lit(lng).cast("double")).withColumn("last_center_lat", F.lit(lat).cast("double"))
    if "lastZoom" in patch:
        now = now.withColumn("last_zoom", F.lit(patch["lastZoom"]).cast("double"))
    return upsert_preferences(preferences, now)


def get_credentials(users: DataFrame, provider_id: str, keys: dict[str, str], user_id: str = "guest") -> DataFrame:
    asked = users.sparkSession.range(1).select(F.lit(provider_id).alias("provider_id"))
    return U.credentials(asked.join(U.tier_of(users, user_id), F.lit(True), "left"), keys)


def get_health(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(True).alias("ok"))
