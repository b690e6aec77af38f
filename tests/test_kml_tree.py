from __future__ import annotations

import pytest

from waymark.sources import files

POINT = "<Point><coordinates>{},{},0</coordinates></Point>"


def mark(tag, name, lng, lat, inner=""):
    return f"<{tag}><name>{name}</name>{POINT.format(lng, lat)}{inner}</{tag}>"


def document(*parts):
    return f'<?xml version="1.0"?>\n<kml xmlns="http://x.example/kml"><Document><name>D</name>{"".join(parts)}</Document></kml>'


def rows(df):
    return [(r.idx, r.name, r.category, r.lng, r.lat) for r in df.orderBy("idx").collect()]


def test_elements_of_any_tag_and_depth(spark, tmp_path):
    data = '<ExtendedData><Data name="Location City"><value>Rome</value></Data></ExtendedData>'
    two = '<ExtendedData><Data name="Location City"><value>Rome</value></Data><Data name="Location State"><value>RM</value></Data></ExtendedData>'
    inside = mark("Placemark", "hidden", 9, 9)
    deep = mark("Placemark", "deep", 7, 8, two)
    for _ in range(6):
        deep = f"<Folder><name>f</name>{deep}</Folder>"
    folder = "<Folder><name>Only</name>" + mark("Placemark", "one", 1, 2, data) + mark("Stop", "stop", 3, 4, inside)
    folder += "<Placemark><name>pathless</name></Placemark>" + mark("Placemark", "12", 5, 6) + mark("Placemark", "out", 500, 6)
    folder += mark("Placemark", "two", 5, 6) + deep + "</Folder>"
    (tmp_path / "a.kml").write_text(document(folder))
    (tmp_path / "b.kml").write_text(document("<Folder><name>x</name></Folder>", "<Folder><name>y</name>" + mark("Place", "last", 1.5, -2.5) + "</Folder>"))
    (tmp_path / "c.kml").write_text("<kml><Document/></kml>")
    found = files.read_kml_tree(spark, f"{tmp_path}/*.kml")
    got = rows(found)
    want = {("one", "Only", 1.0, 2.0), ("stop", "Only", 3.0, 4.0), ("two", "Only", 5.0, 6.0), ("deep", "Only", 7.0, 8.0), ("last", "Uncategorized", 1.5, -2.5)}
    assert {r[1:] for r in got} == want and [r[0] for r in got] == [0, 1, 2, 3, 4] and got[-1][1] == "last"
    assert [r[1] for r in got].index("one") < [r[1] for r in got].index("two")
    address = {r.name: r.address for r in found.collect()}
    assert address["one"] == "Rome" and address["deep"] == "Rome, RM" and address["stop"] is None
    assert {r[2] for r in rows(files.read_kml_tree(spark, f"{tmp_path}/*.kml", "mine"))} == {"mine"}


def test_placemarks_are_those_of_the_splittable_reader(spark, tmp_path):
    parts = "".join(mark("Placemark", f"p{n}", n / 10, n / 20) for n in range(300))
    (tmp_path / "a.kml").write_text(document(f"<Folder><name>One</name>{parts}</Folder>"))
    one, two = (f(spark, f"{tmp_path}/a.kml") for f in (files.read_kml_tree, files.read_kml_places))
    assert rows(one) == rows(two) and len(rows(one)) == 300
    assert one.columns == two.columns


def test_too_deep(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MOST_LEVELS", 3)
    (tmp_path / "a.kml").write_text(document("<Folder><Folder><Folder>" + mark("Placemark", "x", 1, 1) + "</Folder></Folder></Folder>"))
    with pytest.raises(files.BadFile, match="levels"):
        files.read_kml_tree(spark, f"{tmp_path}/a.kml")
