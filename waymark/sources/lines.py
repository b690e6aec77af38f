"""The order of rows in files that Spark splits: by file path, then by place in the file.

Spark packs splits into tasks by size, so ids in the order of tasks aren't in that of files. The rows of one split, though, are read
in order, and the split's offset is known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

FILE, BLOCK, AT = "_file", "_block", "_at"


def located(rows: DataFrame) -> DataFrame:
    """Rows of a file source with _file and _block, the path and the offset of their split. Rows may be dropped afterwards."""
    return rows.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def in_split_order(rows: DataFrame) -> DataFrame:
    """Located rows with _at, which rises within a split. Every scan of the same files gives the same."""
    return rows.withColumn(AT, F.monotonically_increasing_id())


def position() -> Column:
    return F.struct(FILE, BLOCK, AT)


def with_index(rows: DataFrame, name: str = "idx") -> DataFrame:
    """Located rows with their number from 0, in the order of files and lines, in place of _file and _block. Counts of splits are
    summed, a row a split; rows aren't moved."""
    placed = in_split_order(rows)
    splits = placed.groupBy(FILE, BLOCK).agg(F.count("*").alias("_n"), F.min(AT).alias("_first"))
    before = F.sum("_n").over(W.orderBy(FILE, BLOCK)) - F.col("_n")
    starts = splits.select(FILE, BLOCK, (before - F.col("_first")).alias("_start"))
    return placed.join(starts, [FILE, BLOCK]).withColumn(name, F.col(AT) + F.col("_start")).drop(FILE, BLOCK, AT, "_start")
