"""Helpers shared by the text operators: words, shared tables, checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in every operator: a run of anything but blank, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Tables of keys up to this many rows may be broadcast; beyond it callers shuffle.
BROADCAST_ROWS = 200_000


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on this machine."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where a local session names none, as in tests, a temporary folder is set. On a cluster
    a folder of one machine would lose rows, so there the setting is asked for.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(Path(tempfile.mkdtemp(prefix="waymark-")).as_uri())
        path = spark.sparkContext.getCheckpointDir()
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/waymark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there.

    The files outlive the loss of executors. ``clear`` removes them.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete every table that this application has cut. Call it after the results are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/waymark/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a cut table of short keys for broadcast if it has at most ``rows`` rows; else leave it to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z alone; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
