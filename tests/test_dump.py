from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from waymark.operators import upsert
from waymark.sources import dump, files, sinks

KIND = "id bigint, text string, flag boolean, x double, at timestamp"
CONTROLS = "".join(chr(c) for c in range(1, 32)) + "\x7f\x85 "
ROWS = [
    (1, CONTROLS, True, 1.5, None),
    (2, "", False, float("nan"), None),
    (3, None, None, float("-inf"), None),
    (4, "\\N", True, 1e300, None),
    (5, "\\.", True, -0.0, None),
    (6, "COPY public.other (id) FROM stdin;", True, 5e-324, None),
    (7, "\\\\n\\t\\", False, None, None),
    (8, "é😀\t\\\tx\\\\\n", False, 0.1, None),
    (9, "-- Dumped from database version 1", None, 3.0, None),
]


def frame(spark):
    rows = spark.createDataFrame(ROWS, KIND)
    return rows.withColumn("at", F.when(F.col("id") % 2 == 0, F.timestamp_micros(F.col("id") * 1_700_000_000_123_457)))


def one_file(folder, path, before="", after=""):
    """The dump as a single file: its parts in the order of their names."""
    text = before + "".join(p.read_text(newline="") for p in sorted(Path(folder).glob("part-*"))) + after
    Path(path).write_text(text, newline="")
    return text


def plain(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_every_character_comes_back(spark, tmp_path):
    df = frame(spark)
    dump.write_dump(spark, {"first": df, "none": df.limit(0), "other": df.select("id", "text")}, f"{tmp_path}/dump")
    schemas = {"first": df.schema, "none": df.schema, "other": df.select("id", "text").schema}
    text = one_file(f"{tmp_path}/dump", f"{tmp_path}/dump.sql", "-- Dumped by pg_dump version 16\nSET x = 1;\n\n", "\n-- done\n")
    assert text.count("\n\\.\n") == 3 and text.split("\n")[3] == "COPY public.first (id, text, flag, x, at) FROM stdin;"
    for path in (f"{tmp_path}/dump", f"{tmp_path}/dump.sql"):
        found = dump.read_dump(spark, path, schemas)
        assert list(found) == ["first", "none", "other"]
        assert plain(found["first"]) == plain(df)
        assert plain(found["other"]) == plain(df.select("id", "text"))
        assert found["none"].count() == 0
    untyped = dump.read_dump(spark, f"{tmp_path}/dump")["first"]
    assert dict(untyped.dtypes)["x"] == "string" and untyped.count() == len(ROWS)


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    rows = spark.range(30_000).select("id", F.concat(F.lit("row\t\\."), "id").alias("text"))
    dump.write_dump(spark, {"a": rows.where("id % 3 = 0"), "b": rows}, f"{tmp_path}/dump")
    one_file(f"{tmp_path}/dump", f"{tmp_path}/dump.sql")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in kept:
            spark.conf.set(c, "50k")
        found = dump.read_dump(spark, f"{tmp_path}/dump.sql", {"a": rows.schema, "b": rows.schema})
        assert found["b"].rdd.getNumPartitions() > 8
        for name, want in (("a", rows.where("id % 3 = 0")), ("b", rows)):
            assert sinks.digest(found[name]) == sinks.digest(want)
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)


def test_versions_are_stripped_outside_of_rows(spark, tmp_path):
    dump.write_dump(spark, {"first": frame(spark)}, f"{tmp_path}/dump")
    text = one_file(f"{tmp_path}/dump", f"{tmp_path}/in.sql", "-- Dumped from database version 16\n\\restrict x\n-- kept\n", "\\unrestrict x\n")
    dump.strip_versions(spark, f"{tmp_path}/in.sql", f"{tmp_path}/out")
    want = text.replace("-- Dumped from database version 16\n\\restrict x\n", "").replace("\\unrestrict x\n", "")
    assert one_file(f"{tmp_path}/out", f"{tmp_path}/out.sql") == want


def test_bad_dumps(spark, tmp_path):
    path = tmp_path / "bad.sql"
    path.write_text("COPY a (id, text) FROM stdin;\n1\tx\n")
    with pytest.raises(files.BadFile, match="ends within"):
        dump.read_dump(spark, str(path))
    path.write_text("COPY a (id, text) FROM stdin;\n1\tx\n2\n\\.\n")
    with pytest.raises(Exception, match="not 2 fields"):
        dump.read_dump(spark, str(path))["a"].collect()
    path.write_text("-- nothing\n")
    assert dump.read_dump(spark, str(path)) == {}
    path.write_text('COPY "public"."a" ("id", text) FROM stdin;\n1\t\\N\n\\.\nCOPY a (id, text) FROM stdin;\n2\tb\n\\.\n')
    assert plain(dump.read_dump(spark, str(path))["a"]) == ["('1', None)", "('2', 'b')"]


def test_restore_empties_what_the_dump_lacks(spark, tmp_path):
    df = frame(spark).select("id", "text")
    tables = {"first": f"{tmp_path}/first", "gone": f"{tmp_path}/gone"}
    for path in tables.values():
        df.limit(2).write.parquet(path)
    dump.write_dump(spark, {"first": df}, f"{tmp_path}/dump")
    schemas = dict.fromkeys(tables, df.schema)
    with pytest.raises(PermissionError):
        dump.restore_dump(spark, f"{tmp_path}/dump", tables, schemas)
    dump.restore_dump(spark, f"{tmp_path}/dump", tables, schemas, confirmed=True)
    assert plain(spark.read.parquet(tables["first"])) == plain(df) and spark.read.parquet(tables["gone"]).count() == 0


def test_digests_tell_lost_doubled_and_changed_rows(spark, tmp_path):
    df = spark.createDataFrame([(n, None if n % 3 else "a", n / 2) for n in range(50)], "id bigint, text string, x double")
    want = sinks.digest(df)
    assert sinks.digest(df.repartition(7).select("x", "text", "id")) == want
    for other in (
        df.where("id != 7"),
        df.union(df.where("id = 7")),
        df.union(df.where("id = 7")).union(df.where("id = 7")),
        df.withColumn("x", F.when(F.col("id") == 7, 0.0).otherwise(F.col("x"))),
        df.withColumn("text", F.when(F.col("id") == 9, None).otherwise(F.col("text"))),
        df.withColumnRenamed("x", "y"),
    ):
        assert sinks.digest(other) != want
    with pytest.raises(sinks.BadCopy):
        sinks.same_rows("t", df.where("id != 7"), want)
    sinks.replace_table(df, f"{tmp_path}/t")
    sinks.backup(spark, {"t": f"{tmp_path}/t"}, f"{tmp_path}/backup")
    df.where("id != 7").write.mode("overwrite").parquet(f"{tmp_path}/backup/t")  # the backup lost a row
    with pytest.raises(sinks.BadCopy, match="the backup of t"):
        sinks.restore(spark, f"{tmp_path}/backup", {"t": f"{tmp_path}/t"}, confirmed=True)
    assert sinks.digest(spark.read.parquet(f"{tmp_path}/t")) == want


def test_rows_of_a_folder_are_numbered_as_its_files_are_sorted(spark, tmp_path):
    """Small and large files in turn: Spark reads the large ones first. The last row of a key wins."""
    n = 0
    for name, rows in (("a", 2), ("b", 40_000), ("c", 3), ("d", 50_000)):
        lines = []
        for _ in range(rows):
            lines.append(f'{{"name": "{n}", "category": "c", "lng": {n % 90}, "lat": 1}}\n' + ("\n" if n % 1000 == 0 else ""))
            n += 1
        (tmp_path / f"{name}.json").write_text("".join(lines))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700k")
        staged = files.read_json_line_places(spark, f"{tmp_path}/*.json")
        assert staged.where("idx != cast(name AS bigint)").count() == 0 and staged.count() == n
        last = upsert.last_write_wins(staged, ["lng", "lat"], ["idx"])
        assert sorted(int(r.name) for r in last.collect()) == list(range(n - 90, n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_arrays_and_placemarks_of_several_files(spark, tmp_path):
    for name, items in (("a", "[1, 2]"), ("b", "[]"), ("c", '[{"name": "x"}]')):
        (tmp_path / f"{name}.json").write_text(items)
    got = files.read_json_places(spark, f"{tmp_path}/*.json").orderBy("idx").collect()
    assert [(r.idx, r.is_object, r.name) for r in got] == [(0, False, None), (1, False, None), (2, True, "x")]
    mark = "<Placemark><name>{}</name><Point><coordinates>{},2</coordinates></Point></Placemark>"
    folder = lambda name, *marks: f"<Folder><name>{name}</name>{''.join(marks)}</Folder>"
    documents = {
        "a": folder("One", mark.format("p", 1), mark.format("out", 999), mark.format("q", 2)),
        "b": folder("Two", mark.format("r", 3)) + folder("Three", mark.format("s", 4)),
        "c": mark.format("t", 5),
    }
    for name, inner in documents.items():
        (tmp_path / f"{name}.kml").write_text(f"<kml><Document>{inner}</Document></kml>")
    got = files.read_kml_places(spark, f"{tmp_path}/*.kml").orderBy("idx").collect()
    none = "Uncategorized"
    assert [(r.idx, r.name, r.category) for r in got] == [(0, "p", "One"), (1, "q", "One"), (2, "r", none), (3, "s", none), (4, "t", none)]
