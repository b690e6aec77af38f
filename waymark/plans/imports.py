"""Imports: validate every staged row, clean the good ones, write them by key, and account for all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.upsert import unwritable, upsert_places
from ..schemas import IMPORTED, PLACES
from ..sources.sinks import replace_table

#: Rows of a write batch; rows shown by a dry run of JSON and of KML; errors shown.
CHUNK = 500
SHOWN_JSON, SHOWN_KML, SHOWN_ERRORS = 3, 5, 20


# What a bad row is told.
NOT_AN_OBJECT = "Not an object"
NO_NAME = "Missing or empty 'name'"
NO_CATEGORY = "Missing or empty 'category' (provide per-item or use --category flag)"
NO_NUMBER = "Missing or invalid '%s' (must be a number)"
OUT_OF_RANGE = "'%s' out of range: ", " (must be %d to %d)"


def _number_errors(column: str, low: int, high: int) -> list[Column]:
    c = F.col(column)
    missing = c.isNull() | F.isnan(c)
    shown = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))
    before, after = OUT_OF_RANGE
    return [
        F.when(missing, NO_NUMBER % column),
        F.when(~missing & ~c.between(low, high), F.concat(F.lit(before % column), shown, F.lit(after % (low, high)))),
    ]


def validate(staged: DataFrame, default_category: str | None = None) -> DataFrame:
    """``staged`` with chunk (idx div CHUNK) and errors, an array of all that is wrong with a row.

    A row's own category goes before the default one. Rows that aren't objects have that one error.
    """
    rows = staged if "is_object" in staged.columns else staged.withColumn("is_object", F.lit(True))
    if default_category is not None:
        own = F.coalesce(text.trim(F.col("category")), F.lit("")) != ""
        rows = rows.withColumn("category", F.when(own, F.col("category")).otherwise(default_category))
    blank = lambda c: F.coalesce(text.trim(F.col(c)), F.lit("")) == ""
    found = [
        F.when(blank("name"), NO_NAME),
        F.when(blank("category"), NO_CATEGORY),
        *_number_errors("lng", -180, 180),
        *_number_errors("lat", -90, 90),
    ]
    errors = F.when(~F.col("is_object"), F.array(F.lit(NOT_AN_OBJECT))).otherwise(F.array_compact(F.array(*found)))
    return rows.withColumn("errors", errors).withColumn("chunk", F.floor(F.col("idx") / CHUNK)).drop("is_object")


def clean(validated: DataFrame) -> DataFrame:
    """The valid rows: name and category trimmed, blank optional texts null."""
    optional = [c for c in IMPORTED if c not in ("name", "category", "lng", "lat")]
    return validated.where(F.size("errors") == 0).select(
        "idx",
        text.trim(F.col("name")).alias("name"),
        text.trim(F.col("category")).alias("category"),
        *[text.blank_to_null(F.col(c)).alias(c) for c in optional],
        "lng",
        "lat",
    )


def rejected(validated: DataFrame) -> DataFrame:
    """idx, name and the joined errors of the bad rows."""
    return validated.where(F.size("errors") > 0).select("idx", "chunk", "name", F.array_join("errors", "; ").alias("message"))


def first_rejected(validated: DataFrame) -> DataFrame:
    return rejected(validated).orderBy("idx").limit(SHOWN_ERRORS)


def dry_run(cleaned: DataFrame, shown: int = SHOWN_JSON) -> DataFrame:
    """The first rows in input order, as a look before writing."""
    return cleaned.orderBy("idx").limit(shown)


def summary(validated: DataFrame, failed: int = 0) -> DataFrame:
    """One row: total, valid, invalid, inserted, failed, success. Every write counts, also one that a later row replaces."""
    valid = F.count_if(F.size("errors") == 0)
    return validated.agg(
        F.count("*").alias("total"),
        valid.alias("valid"),
        F.count_if(F.size("errors") > 0).alias("invalid"),
        (valid - failed).alias("inserted"),
        F.lit(failed).cast("long").alias("failed"),
    ).withColumn("success", F.col("inserted") == F.col("valid"))


@dataclass(frozen=True)
class Check:
    """A constraint on a row: what is told of rows for which ``holds`` is false. Null holds, as in a database."""

    reason: str
    holds: Column


class Rejected(ValueError):
    """Rows that a table can't take, under a policy that then writes none."""


THERE = "already there"


def with_reason(rows: DataFrame, target: DataFrame, checks: list[Check] = (), unique: list[list[str]] = (), schema=PLACES) -> DataFrame:
    """``rows`` with reason, the first constraint of a table that each breaks, or null.

    Constraints are tried in this order: columns that mustn't be null, the checks, and keys that rows of the target have. All are told in
    one pass over the rows, with one join for each key; keys of the target alone are read, and a null is in no key.
    """
    reasons = [F.when(F.col(f.name).isNull(), f"{f.name}: missing") for f in schema if not f.nullable and f.name in rows.columns]
    reasons += [F.when(~F.coalesce(c.holds, F.lit(True)), c.reason) for c in checks]
    out = rows
    for n, key in enumerate(unique):
        out = out.join(target.select(*key).distinct().withColumn(f"_there{n}", F.lit(True)), key, "left")
        reasons.append(F.when(F.col(f"_there{n}"), f"{', '.join(key)}: {THERE}"))
    told = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    return out.select(*rows.columns, told.alias("reason"))


def admit(told: DataFrame, policy: str = "insert") -> tuple[DataFrame, DataFrame]:
    """(rows to write, failures with their reason) of rows with reason.

    insert: all others are written, and every row with a reason is a failure; skip: rows whose key is there already are left out and are no
    failure; abort: any failure raises Rejected, and nothing is to be written.
    """
    if policy not in ("insert", "skip", "abort"):
        raise ValueError(f"no such policy: {policy}")
    good, bad = told.where("reason IS NULL").drop("reason"), told.where("reason IS NOT NULL")
    if policy == "skip":
        bad = bad.where(~F.col("reason").endswith(f": {THERE}"))
    if policy == "abort" and (first := bad.orderBy("idx").first()) is not None:
        raise Rejected(f"row {first['idx']}: {first['reason']}")
    return good, bad


def reconciled(validated: DataFrame, failures: DataFrame) -> DataFrame:
    """``summary`` with the number of failures counted in the same plan."""
    lost = failures.agg(F.count("*").alias("lost"))
    plain = summary(validated).join(F.broadcast(lost))  # a row each
    counted = plain.withColumn("failed", F.col("lost")).withColumn("inserted", F.col("valid") - F.col("lost")).drop("lost")
    return counted.withColumn("success", F.col("inserted") == F.col("valid"))


@dataclass(frozen=True)
class Outcome:
    inserted: int
    failed: int
    #: The idx of the first rows that failed.
    shown: tuple[int, ...] = ()


class NothingToImport(ValueError):
    """No row of the input is valid."""


def run_import(
    staged: DataFrame, target: DataFrame, path: str, replace: bool = False, default_category: str | None = None
) -> Outcome:
    """Validate, clean and write to the table at ``path`` in one replacement; replace drops the rows that were there.

    No valid row: NothingToImport, before anything is deleted. Rows that validation passes and the table can't take,
    because their id is another place's, are left out and told by idx. Spark writes no single rows, so any other failure fails
    the whole write and leaves the table as it was.
    """
    validated = validate(staged, default_category).persist()
    try:
        valid = summary(validated).first()["valid"]
        if valid == 0:
            raise NothingToImport("no valid rows")
        base, rows = target.limit(0) if replace else target, clean(validated)
        bad = unwritable(base, rows)
        failed = bad.count()
        shown = tuple(r["idx"] for r in bad.orderBy("idx").limit(SHOWN_ERRORS).collect()) if failed else ()
        replace_table(upsert_places(base, rows.join(bad, "idx", "left_anti") if failed else rows), path)
        return Outcome(valid - failed, failed, shown)
    finally:
        validated.unpersist()
