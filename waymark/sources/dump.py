r"""Dumps of tables as text: sections of tab-separated rows, as database clients write and load them.

    COPY public.places (id, name) FROM stdin;
    1<tab>A place
    \.

A null is \N; backslashes and control characters of rows are escaped, so a row is a line, and a line \. ends a section
wherever it stands. A dump is one file or a folder whose files, in the order of their names, are one. Spark splits
either over tasks: a first scan finds where sections begin and end, and each table's rows are the lines between.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructType, TimestampNTZType, TimestampType

from .files import BadFile
from .lines import AT, BLOCK, FILE, in_split_order, located, position
from .sinks import replace_table

NULL, END = r"\N", r"\."
#: How control characters are written, besides the backslash.
ESCAPES = {"\b": r"\b", "\f": r"\f", "\n": r"\n", "\r": r"\r", "\t": r"\t", "\v": r"\v"}
#: Lines that name versions or sessions of the client; they are left out, so that dumps of the same rows are alike.
VERSIONS = r"^(-- Dumped from database version |-- Dumped by pg_dump version |\\restrict |\\unrestrict )"
HEADER = r'^COPY (?:"?[^". ]+"?\.)?"?([^". ]+)"? \((.*)\) FROM stdin;$'
#: Sections that a dump may have: their places are held by the driver.
MOST_SECTIONS = 10_000


def encoded(column: Column, kind) -> Column:
    """A value as the text of a field."""
    if isinstance(kind, BooleanType):
        text = F.when(column, "t").when(~column, "f")
    elif isinstance(kind, TimestampType):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    else:
        text = column.cast("string")
    out = F.replace(text, F.lit("\\"), F.lit(r"\\"))
    for raw, written in ESCAPES.items():
        out = F.replace(out, F.lit(raw), F.lit(written))
    return F.coalesce(out, F.lit(NULL))


def decoded(field: Column, kind) -> Column:
    """The value of a field. Pairs of backslashes are set apart first, so what is left of each escape is one backslash and a letter."""
    pieces = F.split(field, r"\\\\")

    def piece(text: Column) -> Column:
        for raw, written in ESCAPES.items():
            text = F.replace(text, F.lit(written), F.lit(raw))
        return text

    text = F.when(field != NULL, F.array_join(F.transform(pieces, piece), "\\"))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        text = F.regexp_replace(text, r"([+-]\d\d)$", "$1:00")
    return text.cast(kind)


def write_dump(spark: SparkSession, tables: dict[str, DataFrame], folder: str, namespace: str = "public") -> None:
    """Dump tables, in the order given, to the files of a folder. Columns must have types that a string can be cast to."""
    parts = []
    for n, (name, df) in enumerate(tables.items()):
        row = F.array_join(F.array(*[encoded(F.col(f.name), f.dataType) for f in df.schema]), "\t")
        parts.append(df.select(F.lit(n).alias("section"), F.lit(1).alias("place"), row.alias("value")))
        columns = ", ".join(df.columns)
        for place, line in ((0, f"COPY {namespace}.{name} ({columns}) FROM stdin;"), (2, END)):
            parts.append(spark.range(1).select(F.lit(n).alias("section"), F.lit(place).alias("place"), F.lit(line).alias("value")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    ordered = every.repartitionByRange("section", "place", F.xxhash64("value")).sortWithinPartitions("section", "place")
    ordered.select("value").write.mode("overwrite").option("lineSep", "\n").text(folder)


@dataclass(frozen=True)
class Section:
    """A table's rows: the lines between two positions (file, offset of the split, place in it)."""

    table: str
    columns: list[str]
    begin: tuple[str, int, int]
    end: tuple[str, int, int]

    def holds(self) -> Column:
        first, last = (F.struct(F.lit(f).alias(FILE), F.lit(b).cast("long").alias(BLOCK), F.lit(a).cast("long").alias(AT)) for f, b, a in (self.begin, self.end))
        return (position() > first) & (position() < last)


def dump_lines(spark: SparkSession, path: str) -> DataFrame:
    return in_split_order(located(spark.read.option("lineSep", "\n").text(path)))


def sections_of(lines: DataFrame, path: str = "the dump") -> list[Section]:
    """The sections, in order. A row may look like a header: the first header after an end is one, those after it are rows."""
    ends = lines.where(F.col("value") == END).select(position().alias("p")).limit(MOST_SECTIONS + 1).collect()
    if len(ends) > MOST_SECTIONS:
        raise BadFile(f"{path} has more than {MOST_SECTIONS} sections")
    ends = sorted(tuple(r.p) for r in ends)
    listed = [F.struct(F.lit(f).alias(FILE), F.lit(b).cast("long").alias(BLOCK), F.lit(a).cast("long").alias(AT)) for f, b, a in ends]
    heads = lines.where(F.col("value").rlike(HEADER)).select(position().alias("p"), "value")
    nth = F.size(F.filter(F.array(*listed), lambda e: e < F.col("p"))) if listed else F.lit(0)
    found = heads.groupBy(nth.alias("nth")).agg(F.min_by(F.struct("p", "value"), "p").alias("head")).collect()
    out = []
    for r in sorted(found, key=lambda r: r.nth):
        if r.nth >= len(ends):
            raise BadFile(f"{path} ends within a section: {r.head.value}")
        name, columns = _header(r.head.value)
        out.append(Section(name, columns, tuple(r.head.p), ends[r.nth]))
    return out


def _header(line: str) -> tuple[str, list[str]]:
    name, columns = re.match(HEADER, line).groups()
    return name, [c.strip().strip('"') for c in columns.split(",")]


def read_dump(spark: SparkSession, path: str, schemas: dict[str, StructType] | None = None) -> dict[str, DataFrame]:
    """The tables of a dump. Columns that a table's schema has get its types, others are strings.

    A line with another number of fields than its header stops the job that reads it.
    """
    lines = dump_lines(spark, path)
    tables: dict[str, DataFrame] = {}
    for s in sections_of(lines, path):
        kinds = {f.name: f.dataType for f in (schemas or {}).get(s.table, StructType())}
        fields = F.split(F.col("value"), "\t", -1)
        told = F.raise_error(F.concat(F.lit(f"{s.table}: not {len(s.columns)} fields: "), F.substring("value", 1, 200)))
        checked = F.when(F.size(fields) == len(s.columns), fields).otherwise(told.cast("array<string>")).alias("f")
        rows = lines.where(s.holds()).select(checked)
        df = rows.select(*[decoded(F.get("f", F.lit(n)), kinds.get(c, "string")).alias(c) for n, c in enumerate(s.columns)])
        tables[s.table] = tables[s.table].unionByName(df) if s.table in tables else df
    return tables


def strip_versions(spark: SparkSession, path: str, target: str) -> None:
    """Copy a dump without the lines that name versions; rows that look like them stay. The target's files are in the source's order."""
    lines = dump_lines(spark, path)
    inside = F.lit(False)
    for s in sections_of(lines, path):
        inside = inside | s.holds()
    kept = lines.where(inside | ~F.col("value").rlike(VERSIONS))
    kept.repartitionByRange(FILE, BLOCK, AT).sortWithinPartitions(FILE, BLOCK, AT).select("value").write.mode("overwrite").option("lineSep", "\n").text(target)


def restore_dump(spark: SparkSession, path: str, tables: dict[str, str], schemas: dict[str, StructType], confirmed: bool = False) -> None:
    """Empty all of ``tables`` (name -> path) and load those that the dump has. All are read before the first is replaced."""
    if not confirmed:
        raise PermissionError("restoring replaces the tables: pass confirmed=True")
    found = read_dump(spark, path, schemas)
    rows = {n: found[n].select(schemas[n].fieldNames()) if n in found else spark.createDataFrame([], schemas[n]) for n in tables}
    for df in rows.values():
        df.write.format("noop").mode("overwrite").save()
    for name, df in rows.items():
        replace_table(df, tables[name])
