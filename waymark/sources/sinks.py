"""Writers: atomic replacement of a Parquet table, backup, restore and schema artifacts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm.org.apache.hadoop.fs.Path


def folders_in(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Names of the folders in a folder, sorted; complete: of those alone that Spark has finished writing. None if it isn't there."""
    fs, where, at = _fs(spark, path)
    if not fs.exists(where):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())
    return [n for n in names if not complete or fs.exists(at(f"{path}/{n}/_SUCCESS"))]


def located_at(spark: SparkSession, path: str) -> tuple[str, str]:
    """The scheme of the store that a path is in, and the path there."""
    fs, where, _ = _fs(spark, path)
    uri = fs.makeQualified(where).toUri()
    return uri.getScheme(), uri.getPath()


def matches(spark: SparkSession, pattern: str) -> int:
    """How many files and folders a pattern has."""
    fs, where, _ = _fs(spark, pattern)
    return len(fs.globStatus(where) or ())


def remove(spark: SparkSession, path: str) -> None:
    fs, where, _ = _fs(spark, path)
    fs.delete(where, True)


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table, then swap folders: readers see the old rows or the new ones.

    Two renames aren't one transaction: between them the table is missing for a moment, and a
    crash there leaves the old rows in PATH.old-*.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{path}.new-{mark}")
    fs, where, at = _fs(spark, path)
    old = at(f"{path}.old-{mark}")
    had = fs.exists(where)
    if had and not fs.rename(where, old):
        raise OSError(f"{path} can't be moved away")
    if not fs.rename(at(f"{path}.new-{mark}"), where):
        if had:
            fs.rename(old, where)
        raise OSError(f"{path} can't be replaced")
    if had:
        fs.delete(old, True)


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """One small text file under a name of its own, such as a migration."""
    fs, where, _ = _fs(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


#: A task writes so many files about, so that a long folder is many tasks' work.
FILES_A_TASK = 1000


def write_sql_files(files: DataFrame, folder: str) -> None:
    """filename, sql -> a file a row, its text and a line end, for ``files.read_sql_files``; rows are dealt out by name, as few bytes are many files.

    In a shared folder of the file system tasks write FOLDER/NAME themselves: Hadoop's local file system starts two processes a
    file to set permissions. In other stores Spark writes FOLDER/filename=NAME/part-..., and tasks move their own files to their
    places (algorithm 2), not the driver all of them. Either way a task that runs again writes the same names.
    """
    tasks = max(1, -(-files.count() // FILES_A_TASK))
    dealt = files.select("filename", F.coalesce("sql", F.lit("")).alias("sql")).repartition(tasks, "filename")
    store, where = located_at(files.sparkSession, folder)
    if store != "file":
        writer = dealt.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.partitionBy("filename").text(folder)
        return
    path = Path(where)

    def write(rows: Iterator[Row]) -> None:
        path.mkdir(parents=True, exist_ok=True)
        for row in rows:
            (path / row.filename).write_bytes(f"{row.sql}\n".encode())

    dealt.foreachPartition(write)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_json(document: DataFrame, path: str) -> None:
    """A document of one JSON column, such as a feature collection, as text."""
    document.write.mode("overwrite").text(path)


def schema_document(schemas: dict[str, StructType]) -> str:
    """The schemas as one JSON text with sorted keys: the artifact that a contract check compares."""
    return json.dumps({name: schema.jsonValue() for name, schema in schemas.items()}, indent=1, sort_keys=True)


def save_schemas(spark: SparkSession, schemas: dict[str, StructType], path: str) -> None:
    text = schema_document(schemas)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schemas(spark: SparkSession, path: str) -> dict[str, StructType]:
    text = spark.read.text(path, wholetext=True).first()["value"]
    return {name: StructType.fromJson(value) for name, value in json.loads(text).items()}


def schema_drift(spark: SparkSession, schemas: dict[str, StructType], path: str) -> list[str]:
    """Tables whose saved schema isn't the present one."""
    saved = load_schemas(spark, path)
    return sorted(t for t in saved.keys() | schemas.keys() if saved.get(t) != schemas.get(t))


def digest(df: DataFrame) -> dict[str, str]:
    """Numbers that tell the rows of a table, whatever their order: count, and sum and xor of two hashes of each row, columns by name."""
    cells = [c for name in sorted(df.columns) for c in (F.col(name), F.col(name).isNull())]  # hashes pass over nulls
    hashes = {"one": F.xxhash64(F.lit(1), *cells), "two": F.xxhash64(F.lit(2), *cells)}
    sums = [F.sum(h.cast("decimal(38,0)")).alias(f"{n}_sum") for n, h in hashes.items()]
    row = df.agg(F.count("*").alias("rows"), *sums, *[F.bit_xor(h).alias(f"{n}_xor") for n, h in hashes.items()]).first()
    return {name: str(value) for name, value in row.asDict().items()} | {"columns": ",".join(sorted(df.columns))}


class BadCopy(ValueError):
    """Rows that aren't those of the source."""


def same_rows(name: str, df: DataFrame, want: dict[str, str]) -> None:
    """Ask that a table has the digest ``want``."""
    if (have := digest(df)) != want:
        raise BadCopy(f"{name} has {have['rows']} rows of digest {have['one_xor']}, not {want['rows']} of {want['one_xor']}")


def backup(spark: SparkSession, tables: dict[str, str], folder: str) -> None:
    """Copy Parquet tables (name -> path) with their schemas and digests."""
    frames = {name: spark.read.parquet(path) for name, path in tables.items()}
    save_schemas(spark, {name: df.schema for name, df in frames.items()}, f"{folder}/_schemas")
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    digests = json.dumps({name: digest(df) for name, df in frames.items()}, sort_keys=True)
    spark.createDataFrame([(digests,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_digests")


def load_digests(spark: SparkSession, folder: str) -> dict[str, dict[str, str]]:
    """The digests of a backup; none if it has no such file."""
    if "_digests" not in folders_in(spark, folder):
        return {}
    return json.loads(spark.read.text(f"{folder}/_digests", wholetext=True).first()["value"])


def restore(spark: SparkSession, folder: str, tables: dict[str, str], confirmed: bool = False) -> None:
    """Replace tables by their backups. Asks to be told so, since present rows are lost.

    A backup whose rows aren't those of its digests replaces nothing; what was restored is compared too.
    """
    if not confirmed:
        raise PermissionError("restoring replaces the tables: pass confirmed=True")
    schemas, digests = load_schemas(spark, f"{folder}/_schemas"), load_digests(spark, folder)
    saved = {name: spark.read.schema(schemas[name]).parquet(f"{folder}/{name}") for name in tables}
    for name in tables.keys() & digests.keys():
        same_rows(f"the backup of {name}", saved[name], digests[name])
    for name, path in tables.items():
        replace_table(saved[name], path)
        if name in digests:
            same_rows(name, spark.read.schema(schemas[name]).parquet(path), digests[name])


def restore_schemas(spark: SparkSession, folder: str, tables: dict[str, str], confirmed: bool = False) -> None:
    """Drop the tables' rows and make them anew, empty, with the schemas of the backup."""
    if not confirmed:
        raise PermissionError("restoring schemas empties the tables: pass confirmed=True")
    for name, schema in load_schemas(spark, f"{folder}/_schemas").items():
        if name in tables:
            replace_table(spark.createDataFrame([], schema), tables[name])


def copy_database(spark: SparkSession, source: dict[str, str], target: dict[str, str]) -> None:
    """Copy all tables to other places, one after the other, and compare digests; refuses to copy a table onto itself."""
    same = [name for name in source if source[name].rstrip("/") == target.get(name, "").rstrip("/")]
    if same:
        raise ValueError(f"source and target are the same: {', '.join(sorted(same))}")
    for name, path in source.items():
        rows = spark.read.parquet(path)
        replace_table(rows, target[name])
        same_rows(name, spark.read.parquet(target[name]), digest(rows))
