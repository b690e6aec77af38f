from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from waymark.functions import text
from waymark.operators import integrity, places as P, upsert, users as U, viewport as V
from waymark.plans import imports, migrations, requests
from waymark.schemas import PLACES, PREFERENCES, TABLES, USERS
from waymark.sources import files, sinks
from waymark.streaming import debounce as S

T0 = datetime.datetime(2024, 1, 1)


def places(spark, *rows):
    full = [(str(i), f"n{i}", c, None, None, None, None, None, float(x), float(y), T0) for i, (c, x, y) in enumerate(rows)]
    return spark.createDataFrame(full, PLACES)


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def test_boxes(spark):
    rows = places(spark, ("a", 0, 0), ("a", 180, -90), ("b", -180, 90), ("b", 170, 0))
    ids = lambda *box, **k: [r.id for r in V.viewport(rows, V.Box(*box), **k).collect()]
    assert ids(0, 0, 0, 0) == ["0"]
    assert ids(170, -10, -170, 10) == []
    assert ids(-150, -80, 150, 80) == ["0"] and not V.Box(-150, -80, 150, 80).is_world
    assert ids(-151, 5, 150, 6) == ["0", "1", "2", "3"]
    assert ids(-180, -90, 180, 90, category="") == [] and ids(-180, -90, 180, 90, category="b") == ["2", "3"]
    assert [V.limit_for(z) for z in (0, 5, 5.9, 6, 20)] == [500, 500, 500, 5000, 5000]


def test_requests(spark):
    assert V.parse_box(",,,") == V.Box(0, 0, 0, 0) and V.parse_box(" 1 ,2,3e0,-4") == V.Box(1, 2, 3, -4)
    for bad in (None, "", "1,2,3", "1,2,3,x", "1,2,3,nan", "1,2,3,4,5"):
        with pytest.raises(V.BadRequest):
            V.parse_box(bad)
    assert [V.parse_zoom(z) for z in (None, "", "x", "6")] == [0, 0, 0, 6]
    rows = places(spark, ("a", 1, 1))
    got = json.loads(requests.get_places(rows, "0,0,2,2", "7").first()["json"])
    assert got["features"][0]["geometry"] == {"type": "Point", "coordinates": [1.0, 1.0]}
    assert got["features"][0]["properties"] == {"id": "0", "name": "n0", "category": "a", "photo_url": None}
    assert json.loads(requests.get_places(rows, "5,5,6,6").first()["json"])["features"] == []
    assert requests.get_place(rows, "9").count() == 0 and requests.get_place(rows, "0").first().geometry.coordinates == [1, 1]
    assert requests.get_categories(rows).first().categories == ["a"] and requests.get_health(spark).first().ok


def test_preference_patches(spark):
    users = spark.createDataFrame([("guest", "Guest", "free", True), ("p", "P", "premium", False)], USERS)
    prefs = spark.createDataFrame([("guest", "x", 1.0, 2.0, 3.0, T0)], PREFERENCES)
    me = lambda p, u="guest": requests.get_me(users, p, u).first().preferences
    kept = requests.patch_preferences(prefs, "guest", {"lastCenter": None, "basemapId": None})
    assert (me(kept).basemapId, me(kept).lastCenter, me(kept).lastZoom) == (None, [1.0, 2.0], 3.0)
    moved = requests.patch_preferences(prefs, "guest", {"lastCenter": [5, 6], "lastZoom": None})
    assert (me(moved).basemapId, me(moved).lastCenter, me(moved).lastZoom) == ("x", [5.0, 6.0], None)
    fresh = requests.patch_preferences(prefs, "p", {"basemapId": "y"})
    assert fresh.count() == 2 and me(fresh, "p").basemapId == "y" and me(fresh, "p").lastCenter is None
    assert requests.get_me(users, prefs, "nobody").count() == 0
    ask = lambda u, p: requests.get_credentials(users, p, {"thunderforest": "k"}, u).first()
    assert (ask("guest", "thunderforest-x").status, ask("p", "thunderforest-x").api_key) == (403, "k")
    assert (ask("p", "other").status, ask("nobody", "thunderforest").status) == (404, 403)


def test_json_import(spark, tmp_path):
    items = [
        {"name": "  A\t", "category": " Park ", "lng": 180, "lat": -90},
        {"name": "\n", "category": "Park", "lng": 0, "lat": 0},
        {"name": "A", "lng": 0, "lat": 0},
        {"name": "A", "category": "P", "lng": "12", "lat": 0},
        {"name": "A", "category": "P", "lng": 180.01, "lat": 91},
        None,
        5,
        "x",
        {"name": "A", "category": "P", "lng": 1, "lat": 1, "website": "  ", "hours": 7},
        {"name": "B", "category": "P", "lng": 1.0, "lat": 1, "extra": {"lng": 3}},
        [],
        {"name": 3, "category": ["P"], "lng": True, "lat": None},
    ]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(items))
    staged = files.read_json_places(spark, str(path))
    checked = {r.idx: r.errors for r in imports.validate(staged).collect()}
    assert len(checked) == len(items) and [i for i, e in checked.items() if not e] == [0, 8, 9]
    assert checked[1] == [imports.NO_NAME] and checked[2] == [imports.NO_CATEGORY]
    assert checked[3] == ["Missing or invalid 'lng' (must be a number)"]
    assert checked[4] == ["'lng' out of range: 180.01 (must be -180 to 180)", "'lat' out of range: 91 (must be -90 to 90)"]
    assert checked[5] == checked[6] == checked[7] == [imports.NOT_AN_OBJECT] and len(checked[10]) == len(checked[11]) == 4
    assert imports.validate(staged, "P").where("idx = 2").first().errors == []
    target, table = spark.createDataFrame([("old", "O", "c", "d", "p", None, None, None, 1.0, 1.0, T0)], PLACES), str(tmp_path / "t")
    sinks.replace_table(target, table)
    outcome = imports.run_import(staged, spark.read.parquet(table), table)
    assert (outcome.inserted, outcome.failed) == (3, 0)
    rows = {r.name: r for r in spark.read.parquet(table).collect()}
    assert rows.keys() == {"A", "B"} and (rows["B"].id, rows["B"].created_at, rows["B"].photo_url) == ("old", T0, None)
    assert (rows["A"].category, rows["A"].lng, rows["A"].website) == ("Park", 180.0, None)
    with pytest.raises(imports.NothingToImport):
        imports.run_import(staged.where("idx = 1"), spark.read.parquet(table), table, replace=True)
    assert spark.read.parquet(table).count() == 2
    imports.run_import(staged.where("idx = 0"), spark.read.parquet(table), table, replace=True)
    assert spark.read.parquet(table).count() == 1
    for bad in ('{"a": 1}', "[1,", ""):
        path.write_text(bad)
        with pytest.raises(files.BadFile):
            files.read_json_places(spark, str(path))


def test_json_lines_are_split_over_tasks(spark, tmp_path):
    items = [None, 5, "x", [], {"name": 3, "category": ["P"], "lng": True, "lat": None}]
    items += [{"name": f"é{i}", "category": "P", "lng": i / 10, "lat": "1" if i % 7 == 0 else 1} for i in range(500)]
    array, lines = tmp_path / "a.json", tmp_path / "a.jsonl"
    array.write_text(json.dumps(items))
    lines.write_text("\n".join(json.dumps(x) + "\n" * (i % 3 == 0) for i, x in enumerate(items)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000b")
    try:
        assert spark.read.text(str(lines)).rdd.getNumPartitions() > 2
        got = sorted(files.read_json_line_places(spark, str(lines)).collect(), key=lambda r: r.idx)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == sorted(files.read_json_places(spark, str(array)).collect(), key=lambda r: r.idx) and len(got) == 505
    lines.write_text('{"name": "A"}\n[1,\n')
    with pytest.raises(files.BadFile):
        files.read_json_line_places(spark, str(lines))


MARK = "<Placemark><name>{}</name>{}<Point><coordinates>{}</coordinates></Point></Placemark>"


def kml(body, folders=1):
    inner = "".join(f"<Folder><name>F{i}</name>{body if i == 0 else '<Placemark/>'}</Folder>" for i in range(folders)) or body
    return f'<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>d</name>{inner}</Document></kml>'


def test_kml_import(spark, tmp_path):
    data = '<ExtendedData><Data name="City"><value>Rome</value></Data></ExtendedData>'
    more = data.replace("</ExtendedData>", '<Data name="Web link"><value>http://x.example.com</value></Data></ExtendedData>')
    body = (
        MARK.format("<![CDATA[ A ]]>", "<description><![CDATA[one<br/>two <a href='http://y.example.com/z'>z</a>]]></description>", "1,2,3")
        + "<Folder><Placemark><name>deep</name>" + more + "<Point><coordinates> 3.5abc , -4 </coordinates></Point></Placemark></Folder>".replace("Folder", "Sub")
        + MARK.format("42", "", "5,6")
        + MARK.format("far", "", "500,6")
        + MARK.format("odd", data, "7,8")
    ).replace("<Folder>", "<Sub>")
    path = tmp_path / "a.kml"
    path.write_text(kml(body))
    rows = {r.name: r for r in files.read_kml_places(spark, str(path)).collect()}
    assert rows.keys() == {"A", "deep", "odd"} and {r.category for r in rows.values()} == {"F0"}
    assert (rows["A"].description, rows["A"].website) == ("one\ntwo z", "http://y.example.com/z'".rstrip("'") + "'")
    assert (rows["deep"].lng, rows["deep"].lat, rows["deep"].website, rows["deep"].address) == (3.5, -4.0, "http://x.example.com", "Rome")
    assert rows["odd"].description == "City: Rome" and rows["odd"].hours is None
    assert {r.category for r in files.read_kml_places(spark, str(path), "mine").collect()} == {"mine"}
    for n in (0, 2):
        path.write_text(kml(body, n))
        assert {r.category for r in files.read_kml_places(spark, str(path)).collect()} == {"Uncategorized"}


def test_texts(spark):
    t = F.col("t")
    assert one(spark, text.trim(t), t="﻿  a b \n") == "a b"
    assert one(spark, text.linkify(t), t='see www.a.com/x). & "q" https://b.org/?a=1&b=2!') == (
        'see <a href="https://www.a.com/x">www.a.com/x</a>). &amp; &quot;q&quot; '
        '<a href="https://b.org/?a=1&amp;b=2">https://b.org/?a=1&amp;b=2</a>!'
    )
    assert one(spark, text.linkify(t), t="no < link") == "no &lt; link"
    assert one(spark, text.prepare_description(t), t=" \n") == "" and one(spark, text.prepare_description(t), t="<A href='x'>") == "<A href='x'>"
    clean = one(spark, text.sanitise(t), t='<a onclick="x" href="https://e.org">k</a><script>bad()</script><p style="c">t</p><div>u</div><a href="javascript:x">v</a>')
    assert clean == '<a href="https://e.org" target="_blank" rel="noopener noreferrer">k</a><p>t</p>u<a>v</a>'
    numbers = {"12abc": 12.0, " -.5e2x": -50.0, "abc": None, "": None, "7.": 7.0}
    assert {k: one(spark, text.number_prefix(t), t=k) for k in numbers} == numbers
    assert one(spark, text.in_range(F.lit(float("nan")), F.lit(0.0)), t=1) is False
    assert [one(spark, text.round_half_up(F.lit(x)), t=1) for x in (2.5, -2.5, 1.49)] == [3, -2, 1]
    sql = "\\restrict x\nCREATE SCHEMA public;\n  COMMENT ON SCHEMA public IS 'standard public schema';\r\nSELECT 1;\n-- cursor:no-transaction "
    assert one(spark, text.executable_lines(t), t=sql) == "SELECT 1;\n-- cursor:no-transaction "
    assert one(spark, text.wants_transaction(t), t=sql) is False


def test_upserts(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 1)], "k int, v string, idx int")
    assert sorted(map(tuple, upsert.last_write_wins(rows, ["k"], ["idx"]).collect())) == [(1, None, 2), (2, "b", 1)]
    times = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, None)], "k int, created_at int")
    assert sorted(map(str, upsert.newest_per_key(times, ["k"]).collect())) == sorted(
        map(str, spark.createDataFrame([(1, 2), (1, 2), (2, None)], times.schema).collect())
    )
    both, bad = upsert.plain_insert(rows, rows.limit(1), ["k", "idx"])
    assert both.count() == 4 and bad.count() == 1
    assert integrity.outside(spark.createDataFrame([("gold",), (None,), ("free",)], "tier string"), "tier", ["free"]).count() == 2


def test_plain_insert_counts_the_target_once_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (2, "x"), (2, "y"), (4, "x"), (5, "x"), (5, "y")], "k int, v string")
    both, bad = upsert.plain_insert(target, source, ["k"])
    assert both.count() == 11
    assert sorted(map(tuple, bad.select("k", "n").collect())) == [(1, 2), (2, 3), (5, 2)]


def test_sql_files_are_written_by_many_tasks_and_listed_once(spark, tmp_path):
    odd = spark.createDataFrame([("a b%41é.sql", "SELECT 'ü';"), ("z.sql", None)], "filename string, sql string")
    rows = spark.range(2500).coalesce(1).selectExpr("lpad(id, 6, '0') || '.sql' AS filename", "'-- ' || id AS sql").unionByName(odd)
    want = sorted((r.filename, f"{r.sql or ''}\n") for r in rows.collect())
    sinks.write_sql_files(rows, f"file://{tmp_path}/m m")
    sinks.write_file(spark, f"{tmp_path}/m m/README.md", "no")
    (tmp_path / "m m" / "k=1").mkdir()
    (tmp_path / "m m" / "k=1" / "inner.sql").write_text("no")
    assert (tmp_path / "m m" / "000007.sql").read_bytes() == b"-- 7\n"
    read = files.read_sql_files(spark, f"{tmp_path}/m m")
    assert sorted(map(tuple, read.collect())) == want and read.columns == ["filename", "sql"]
    rows.where("filename < '000010'").selectExpr("filename", "sql AS value").write.partitionBy("filename").text(f"{tmp_path}/by spark")
    assert sorted(map(tuple, files.read_sql_files(spark, f"{tmp_path}/by spark").collect())) == want[:10]


def test_migration_files(spark, tmp_path):
    (tmp_path / "m").mkdir()
    for name, body in (("2__b.sql", "B"), ("1__a.sql", "A"), ("note.txt", "x")):
        (tmp_path / "m" / name).write_text(body)
    listed = files.read_sql_files(spark, str(tmp_path / "m"))
    ledger = spark.createDataFrame([("1__a.sql", "other", T0)], TABLES["ledger"])
    assert [r.filename for r in migrations.pending(listed, ledger).collect()] == ["2__b.sql"]
    assert [r.filename for r in migrations.changed(listed, ledger).collect()] == ["1__a.sql"]
    noted = {r.filename: r.checksum for r in migrations.baseline(listed, ledger).collect()}
    assert noted["1__a.sql"] == "other" and len(noted) == 2
    versions = spark.createDataFrame([("9.2",), ("10.1",), ("10.1.3",)], "version string")
    assert migrations.latest_version(versions).first().latest == "10.1.3"


def test_backup_and_restore(spark, tmp_path):
    table, folder, other = (str(tmp_path / x) for x in ("t", "b", "o"))
    sinks.replace_table(places(spark, ("a", 0, 0)), table)
    sinks.backup(spark, {"places": table}, folder)
    sinks.append(places(spark, ("b", 1, 1)), table)
    assert spark.read.parquet(table).count() == 2
    with pytest.raises(PermissionError):
        sinks.restore(spark, folder, {"places": table})
    sinks.restore(spark, folder, {"places": table}, confirmed=True)
    assert spark.read.parquet(table).count() == 1
    sinks.copy_database(spark, {"places": table}, {"places": other})
    assert spark.read.parquet(other).count() == 1
    with pytest.raises(ValueError):
        sinks.copy_database(spark, {"places": table}, {"places": table + "/"})
    sinks.restore_schemas(spark, folder, {"places": table}, confirmed=True)
    assert spark.read.parquet(table).count() == 0 and spark.read.parquet(table).columns == PLACES.names
    sinks.save_schemas(spark, TABLES, str(tmp_path / "s"))
    assert sinks.schema_drift(spark, TABLES, str(tmp_path / "s")) == []
    assert sinks.schema_drift(spark, {**TABLES, "users": PLACES}, str(tmp_path / "s")) == ["users"]
    sinks.write_json(V.as_json(V.collection(places(spark, ("a", 0, 0)))), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["type"] == "FeatureCollection"


def test_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS waymark_test")
    spark.sql(f"CREATE TABLE waymark_test.users (id STRING, tier STRING) USING parquet LOCATION '{tmp_path}/users'")
    try:
        missing = integrity.missing_columns(integrity.columns_of({"users": USERS}, spark), integrity.catalog_columns(spark, "waymark_test"))
        assert sorted(r.column_name for r in missing.collect()) == ["display_name", "is_guest"]
    finally:
        spark.sql("DROP DATABASE waymark_test CASCADE")


def test_numbering(spark):
    rows = spark.range(1000).select(F.concat(F.lit("k"), F.lpad("id", 4, "0")).alias("k"))
    out = files.numbered(rows, "k").collect()
    assert sorted((r.idx, r.k) for r in out) == [(i, f"k{i:04d}") for i in range(1000)]


def test_clusters(spark):
    near = [("a", 10 + i / 1e6, 10) for i in range(12)] + [("a", -100, 50)]
    got = P.clusters(places(spark, *near), 3).collect()
    assert sorted((r.point_count, r.size) for r in got if r.id is None) == [(12, 13)] and [r.id for r in got if r.id] == ["12"]
    assert P.clusters(places(spark, *near), 11).where("point_count IS NOT NULL").count() == 0


def test_debounce_on_a_stream(spark, tmp_path):
    events = [("u", 0, 1), ("u", 1, 2), ("u", 10, 3), ("v", 0, 4), ("w", 100, 5)]
    schema = "user_id string, ts timestamp, value int"
    rows = spark.createDataFrame([(u, T0 + datetime.timedelta(seconds=s), v) for u, s, v in events], schema)
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got = []
    write = lambda df, _: got.extend((r.user_id, r.n, r.value) for r in df.collect())
    run = S.save_stream(S.debounced_stream(stream), write, str(tmp_path / "cp"))
    run.awaitTermination(60)
    assert sorted(got) == [("u", 1, 3), ("u", 2, 2), ("v", 1, 4)]
    assert S.debounce(rows, S.SAVE_GAP).count() == 4


def test_toggles(spark):
    clicks = spark.createDataFrame([("u", i, i, p) for i, p in enumerate("aabba")], "user_id string, ts int, event_id int, place string")
    got = [r.selected for r in U.toggled(clicks).orderBy("event_id").collect()]
    assert got == ["a", None, "b", None, "a"]


def test_a_small_import_leaves_the_target_where_it_is(spark, tmp_path):
    """The keys of an import are broadcast: no exchange of the target's rows but of those that the import meets."""
    target = spark.range(2000).selectExpr(
        "cast(id AS string) AS id", "'n' AS name", "'c' AS category", "cast(null AS string) AS description", "cast(null AS string) AS photo_url",
        "cast(null AS string) AS address", "cast(null AS string) AS website", "cast(null AS string) AS hours",
        "cast(id AS double) AS lng", "0.0D AS lat", "timestamp'2024-01-01' AS created_at",
    )
    target.write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    source = target.where("lng < 3").select(*[c for c in target.columns if c not in ("id", "created_at")], F.col("lng").cast("long").alias("idx"))
    out = upsert.upsert_places(target, source)
    assert out.count() == 2000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti, BuildRight" in plan


def test_rows_that_cant_be_written_are_told(spark, tmp_path):
    taken = one(spark, upsert.place_id(F.lit(1.0), F.lit(1.0)))
    target = spark.createDataFrame([(taken, "O", "c", None, None, None, None, None, 5.0, 5.0, T0)], PLACES)
    table = str(tmp_path / "t")
    sinks.replace_table(target, table)
    text_columns = "description string, photo_url string, address string, website string, hours string"
    rows = [(i, f"n{i}", "c", None, None, None, None, None, float(i), float(i)) for i in range(3)]
    staged = spark.createDataFrame(rows, f"idx bigint, name string, category string, {text_columns}, lng double, lat double")
    outcome = imports.run_import(staged, spark.read.parquet(table), table)
    assert (outcome.inserted, outcome.failed, outcome.shown) == (2, 1, (1,))
    assert {r.name for r in spark.read.parquet(table).collect()} == {"O", "n0", "n2"}


def test_boxes_of_a_table_are_those_of_single_requests(spark):
    boxes = ["1,2,3,4", " 1 ,2,3e0,-4", ",,,", "1,2,3", "1,2,3,4,5", "1,2,3,x", "", None, "0x1F,0b11,0o17,.5", "1_0,2,3,4", "+1.,-.5,Infinity,-Infinity", "inf,1,2,3", "0x,1,2,3", "1e400,0,0,0"]
    zooms = ["7", "5.9", "6", "x", "", None, " 6 ", "1e1"]
    asked = [(b, z) for b in boxes for z in zooms]
    rows = V.understood(spark.createDataFrame(asked, "box string, zoom_text string")).collect()
    for r in rows:
        try:
            b = V.parse_box(r.box)
            zoom = V.parse_zoom(r.zoom_text)
            want = (200, b.west, b.south, b.east, b.north, zoom, V.limit_for(zoom))
        except V.BadRequest:
            want = (400, *[None] * 6)
        assert tuple(r)[2:] == want, r


def test_providers_of_requests(spark):
    asked = spark.createDataFrame([("opentopomap",), ("gone",), (None,)], "provider_id string")
    got = [(r.provider_id, r.provider, r.provider_max_zoom) for r in U.with_provider(asked).collect()]
    assert sorted(got, key=str) == sorted([("opentopomap", "opentopomap", 17), ("gone", U.DEFAULT_PROVIDER, 19), (None, U.DEFAULT_PROVIDER, 19)], key=str)
