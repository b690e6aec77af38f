"""Migrations: files against a ledger of checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.upsert import insert_or_ignore


def with_checksums(files: DataFrame) -> DataFrame:
    """filename, sql, checksum (of the raw text), executable, transactional."""
    return files.select(
        "filename",
        "sql",
        F.sha2("sql", 256).alias("checksum"),
        text.executable_lines(F.col("sql")).alias("executable"),
        text.wants_transaction(F.col("sql")).alias("transactional"),
    )


def pending(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger lacks, in the order to apply them."""
    return with_checksums(files).join(ledger.select("filename"), "filename", "left_anti").orderBy("filename")


def changed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that were applied with another text: an error."""
    known = ledger.select("filename", F.col("checksum").alias("applied_checksum"))
    return with_checksums(files).join(known, "filename").where("checksum != applied_checksum").select("filename", "checksum", "applied_checksum")


def baseline(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger after all files are noted as applied; what it knows stays."""
    noted = with_checksums(files).select("filename", "checksum").withColumn("applied_at", F.current_timestamp())
    return insert_or_ignore(ledger, noted.select(ledger.columns), ["filename"])


def new_filename(title, ts):
    """YYYYMMDDHHMM__slug.sql"""
    return F.concat(text.stamp(ts), F.lit("__"), text.slug(title), F.lit(".sql"))


def latest_version(versions: DataFrame, column: str = "version") -> DataFrame:
    """The highest of dotted version texts, compared number by number."""
    parts = F.transform(F.split(column, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)))
    return versions.agg(F.max_by(F.col(column), parts).alias("latest"))
