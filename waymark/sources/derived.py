"""Logical tables derived from the star schema, which has no coordinates and no users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START = 1_704_067_200  # 2024-01-01 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = key.cast("string")
    return table(spark, sf_dir, "customer").select(
        text.alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("category"),
        F.when(key % 4 > 0, F.concat(F.lit("Place "), text)).alias("description"),
        F.when(key % 3 > 0, F.concat(F.lit("https://img.example.com/"), text)).alias("photo_url"),
        F.concat(F.lit("Street "), text).alias("address"),
        F.when(key % 5 > 0, F.concat(F.lit("https://www.example.com/"), text)).alias("website"),
        F.lit(None).cast("string").alias("hours"),
        ((key * 7919 % 36000).cast("double") / 100 - 180).alias("lng"),
        ((key * 104729 % 18000).cast("double") / 100 - 90).alias("lat"),
        F.timestamp_seconds(START + key * 60).alias("created_at"),
    )


PLACES_SQL = """
places AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS category,
    CASE WHEN c_custkey % 4 > 0 THEN 'Place ' || c_custkey END AS description,
    CASE WHEN c_custkey % 3 > 0 THEN 'https://img.example.com/' || c_custkey END AS photo_url,
    'Street ' || c_custkey AS address,
    CASE WHEN c_custkey % 5 > 0 THEN 'https://www.example.com/' || c_custkey END AS website,
    CAST(NULL AS VARCHAR) AS hours,
    CAST(c_custkey * 7919 % 36000 AS DOUBLE) / 100 - 180 AS lng,
    CAST(c_custkey * 104729 % 18000 AS DOUBLE) / 100 - 90 AS lat,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey * 60) AS created_at
  FROM customer)"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("display_name"),
        F.when(F.col("c_acctbal") > 5000, "premium").otherwise("free").alias("tier"),
        (F.col("c_custkey") % 10 == 0).alias("is_guest"),
    )


USERS_SQL = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS display_name,
    CASE WHEN c_acctbal > 5000 THEN 'premium' ELSE 'free' END AS tier, c_custkey % 10 = 0 AS is_guest
  FROM customer)"""


def preference_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of patches: which fields each has, and their values. An error event changes nothing."""
    kind, n = F.col("event_type"), F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        "ts",
        "event_id",
        kind.isin("click", "signup").alias("has_basemap"),
        F.when(kind == "click", F.concat(F.lit("map-"), (n % 7).cast("string"))).alias("basemap_id"),
        F.when(kind == "view", F.array((n % 360 - 180).cast("double"), (n % 180 - 90).cast("double"))).alias("last_center"),
        (kind == "purchase").alias("has_zoom"),
        F.when((kind == "purchase") & (n % 5 > 0), (n % 20).cast("double")).alias("last_zoom"),
    )


PATCHES_SQL = """
patches AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, ts, event_id, event_type IN ('click', 'signup') AS has_basemap,
    CASE WHEN event_type = 'click' THEN 'map-' || (event_id % 7) END AS basemap_id,
    event_type = 'view' AS has_center, CAST(event_id % 360 - 180 AS DOUBLE) AS lng, CAST(event_id % 180 - 90 AS DOUBLE) AS lat,
    event_type = 'purchase' AS has_zoom,
    CASE WHEN event_type = 'purchase' AND event_id % 5 > 0 THEN CAST(event_id % 20 AS DOUBLE) END AS last_zoom
  FROM events)"""


def staged_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw import rows in input order (idx): some with blank names, coordinates out of range or NaN, repeated keys."""
    n, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    return table(spark, sf_dir, "events").select(
        n.alias("idx"),
        F.when(n % 11 == 0, F.lit(" \t\n")).when(n % 13 > 0, F.concat(F.lit("  Stop "), user.cast("string"), F.lit("\t"))).alias("name"),
        F.when(n % 17 > 0, F.col("event_type")).alias("category"),
        F.when(n % 3 > 0, F.concat(F.lit(" note "), n.cast("string"))).otherwise(F.lit("  ")).alias("description"),
        F.lit(None).cast("string").alias("photo_url"),
        F.lit(None).cast("string").alias("address"),
        F.when(n % 4 == 0, F.concat(F.lit("https://www.example.com/"), user.cast("string"))).alias("website"),
        F.lit(None).cast("string").alias("hours"),
        F.when(n % 19 == 0, F.lit(float("nan")))
        .when(value > 200, value)
        .otherwise((user * 7919 % 36000).cast("double") / 100 - 180)
        .alias("lng"),
        F.when(n % 23 > 0, (F.length("event_type") * 10 + user % 20 - 70).cast("double")).alias("lat"),
    )


STAGED_SQL = """
staged AS (
  SELECT event_id AS idx,
    CASE WHEN event_id % 11 = 0 THEN ' ' || chr(9) || chr(10) WHEN event_id % 13 > 0 THEN '  Stop ' || user_id || chr(9) END AS name,
    CASE WHEN event_id % 17 > 0 THEN event_type END AS category,
    CASE WHEN event_id % 3 > 0 THEN ' note ' || event_id ELSE '  ' END AS description,
    CAST(NULL AS VARCHAR) AS photo_url, CAST(NULL AS VARCHAR) AS address,
    CASE WHEN event_id % 4 = 0 THEN 'https://www.example.com/' || user_id END AS website, CAST(NULL AS VARCHAR) AS hours,
    CASE WHEN event_id % 19 = 0 THEN CAST('nan' AS DOUBLE) WHEN value > 200 THEN value
      ELSE CAST(user_id * 7919 % 36000 AS DOUBLE) / 100 - 180 END AS lng,
    CASE WHEN event_id % 23 > 0 THEN CAST(length(event_type) * 10 + user_id % 20 - 70 AS DOUBLE) END AS lat
  FROM events)"""


def migrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with their SQL; the ledger below knows some of them, one in forty of those with another checksum."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lpad(key.cast("string"), 8, "0"), F.lit("__"), F.lower(F.regexp_replace("p_type", "[^A-Za-z]+", "_")), F.lit(".sql")).alias("filename"),
        F.concat(F.lit("ALTER TABLE t ADD COLUMN c"), key.cast("string"), F.lit(" int;\n\\connect x\n"), F.col("p_name")).alias("sql"),
        key.alias("key"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = migrations(spark, sf_dir).where("key % 7 > 1")
    return known.select(
        "filename",
        F.when(F.col("key") % 40 == 0, F.lit("changed")).otherwise(F.sha2("sql", 256)).alias("checksum"),
    )


MIGRATIONS_SQL = r"""
migrations AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') || '__' || lower(regexp_replace(p_type, '[^A-Za-z]+', '_', 'g')) || '.sql' AS filename,
    'ALTER TABLE t ADD COLUMN c' || p_partkey || ' int;' || chr(10) || '\connect x' || chr(10) || p_name AS sql, p_partkey AS key
  FROM part),
ledger AS (
  SELECT filename, CASE WHEN key % 40 = 0 THEN 'changed' ELSE sha256(sql) END AS checksum FROM migrations WHERE key % 7 > 1)"""
