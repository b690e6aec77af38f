"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.10g}"
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(plain(row[i])) for i in order) for row in rows)


def compare(spark, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck(sf_dir).sql(sql)
    want = rows_of(result.columns, result.fetchall())
    assert sorted(df.columns) == sorted(result.columns), (name, df.columns, result.columns)
    assert len(got) == len(want), (name, len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, (name, len(bad), bad[:2])
    return len(got)
