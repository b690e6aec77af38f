"""Assertions that stand for keys, checks and references, and comparison with a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .upsert import duplicate_keys

# The database's type names and the types that applications see.
TYPES = {
    "number": ["int2", "int4", "int8", "float4", "float8", "numeric", "money"],
    "boolean": ["bool"],
    "unknown": ["json", "jsonb"],
    "Date": ["date", "timestamp", "timestamptz", "time", "timetz"],
    "string": ["uuid", "text", "varchar", "bpchar", "char", "name", "vector", "interval"],
    "Buffer": ["bytea"],
}


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows whose key isn't null and isn't in the parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def cascade(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """What is left of the child after rows of the parent were deleted."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def outside(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    return rows.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def columns_of(schemas: dict[str, StructType], spark: SparkSession) -> DataFrame:
    """table_name, column_name, ordinal, data_type, is_nullable of some schemas."""
    rows = [
        (t, f.name, i, f.dataType.simpleString(), f.nullable)
        for t, schema in sorted(schemas.items())
        for i, f in enumerate(schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal int, data_type string, is_nullable boolean")


def catalog_columns(spark: SparkSession, database: str = "default") -> DataFrame:
    """The same for the tables of a catalog database."""
    tables = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return columns_of({t: spark.table(f"{database}.{t}").schema for t in tables}, spark)


def constraints(spark: SparkSession) -> DataFrame:
    """Keys, checks and references of the tables, as declared in schemas.py: table_name, kind, definition."""
    from ..schemas import PLACE_KEY, TIERS

    rows = [
        ("places", "key", "id"),
        ("places", "unique", ",".join(PLACE_KEY)),
        ("users", "key", "id"),
        ("users", "check", f"tier IN ({', '.join(TIERS)})"),
        ("preferences", "key", "user_id"),
        ("preferences", "reference", "user_id -> users.id"),
        ("ledger", "key", "filename"),
    ]
    return spark.createDataFrame(rows, "table_name string, kind string, definition string")


def constraint_report(places: DataFrame, users: DataFrame, preferences: DataFrame, ledger: DataFrame) -> DataFrame:
    """The declared constraints with n, the number of rows (of keys: of keys that are there several times) that break each."""
    from ..schemas import PLACE_KEY, TIERS

    broken = {
        ("places", "key"): duplicate_keys(places, ["id"]),
        ("places", "unique"): duplicate_keys(places, PLACE_KEY),
        ("users", "key"): duplicate_keys(users, ["id"]),
        ("users", "check"): outside(users, "tier", TIERS),
        ("preferences", "key"): duplicate_keys(preferences, ["user_id"]),
        ("preferences", "reference"): orphans(preferences, users, "user_id", "id"),
        ("ledger", "key"): duplicate_keys(ledger, ["filename"]),
    }
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), F.lit(k).alias("kind"), "n") for (t, k), df in broken.items()]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return constraints(places.sparkSession).join(out, ["table_name", "kind"])


def missing_columns(expected: DataFrame, present: DataFrame) -> DataFrame:
    key = ["table_name", "column_name"]
    return expected.join(present.select(key), key, "left_anti")


def column_lists(columns: DataFrame) -> DataFrame:
    """One row a table: its column names in order, as text."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "column_name")))
    return columns.groupBy("table_name").agg(
        F.array_join(F.transform(ordered, lambda c: c["column_name"]), ",").alias("columns")
    )


def enum_labels(types: DataFrame, labels: DataFrame, namespaces: DataFrame, namespace: str) -> DataFrame:
    """(type, sort_order, label) rows of the enums of a namespace, in order: a chain of three inner joins."""
    spaces = namespaces.where(F.col("namespace") == namespace).select("namespace_id")
    return (
        labels.join(types, "type_id")
        .join(F.broadcast(spaces.limit(1)), "namespace_id")
        .select("type_name", "sort_order", "label")
        .orderBy("type_name", "sort_order")
    )


#: Names that the database has for Spark's types.
UDTS = {
    "smallint": "int2", "int": "int4", "bigint": "int8", "float": "float4", "double": "float8", "boolean": "bool", "date": "date",
    "timestamp": "timestamptz", "timestamp_ntz": "timestamp", "string": "text", "binary": "bytea",
}


def udt(data_type: str):
    """The database's name of a column of Spark type names: an underscore goes before an array's."""
    pairs = [F.lit(x) for pair in UDTS.items() for x in pair]
    inner = F.regexp_replace(F.regexp_replace(data_type, r"^array<(.*)>$", "$1"), r"\(.*\)$", "")
    name = F.coalesce(F.try_element_at(F.create_map(*pairs), inner), F.when(inner.startswith("decimal"), "numeric"), inner)
    return F.when(F.startswith(F.col(data_type), F.lit("array<")), F.concat(F.lit("_"), name)).otherwise(name)


def type_name(column: str):
    """The application's type of a database type; an underscore before a name is an array of it."""
    pairs = [F.lit(x) for mapped, names in TYPES.items() for name in names for x in (name, mapped)]
    known = F.create_map(*pairs)
    bare = F.regexp_replace(column, "^_", "")
    simple = F.coalesce(F.try_element_at(known, bare), F.lit("unknown"))
    return F.when(F.startswith(F.col(column), F.lit("_")), F.concat(F.lit("Array<"), simple, F.lit(">"))).otherwise(simple)


def report(places: DataFrame, users: DataFrame, preferences: DataFrame) -> DataFrame:
    """One row per invariant: name and the number of violations."""
    from ..schemas import PLACE_KEY, TIERS

    checks = {
        "places_key": duplicate_keys(places, PLACE_KEY),
        "places_id": duplicate_keys(places, ["id"]),
        "users_tier": outside(users, "tier", TIERS),
        "preferences_user": orphans(preferences, users, "user_id", "id"),
    }
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("invariant"), "n") for k, df in checks.items()]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out
