"""Schemas of the tables, and their keys and checks. Spark enforces none of these; operators/integrity.py asserts them."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind(), nullable) for name, kind, nullable in fields])


PLACES = _struct(
    ("id", StringType, False),
    ("name", StringType, False),
    ("category", StringType, False),
    ("description", StringType, True),
    ("photo_url", StringType, True),
    ("address", StringType, True),
    ("website", StringType, True),
    ("hours", StringType, True),
    ("lng", DoubleType, False),
    ("lat", DoubleType, False),
    ("created_at", TimestampType, True),
)
USERS = _struct(
    ("id", StringType, False),
    ("display_name", StringType, True),
    ("tier", StringType, False),
    ("is_guest", BooleanType, False),
)
PREFERENCES = _struct(
    ("user_id", StringType, False),
    ("basemap_id", StringType, True),
    ("last_center_lng", DoubleType, True),
    ("last_center_lat", DoubleType, True),
    ("last_zoom", DoubleType, True),
    ("updated_at", TimestampType, True),
)
LEDGER = _struct(("filename", StringType, False), ("checksum", StringType, False), ("applied_at", TimestampType, True))

#: The columns that an import writes, and the key on which rows meet.
IMPORTED = ["name", "category", "description", "photo_url", "address", "website", "hours", "lng", "lat"]
PLACE_KEY = ["lng", "lat"]
TIERS = ["free", "premium"]
TABLES = {"places": PLACES, "users": USERS, "preferences": PREFERENCES, "ledger": LEDGER}
