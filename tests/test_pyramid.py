from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from waymark.operators import pyramid as T
from waymark.operators import viewport as V

BOXES = [V.Box(-180, -90, 180, 90), V.Box(-10, -10, 40, 50), V.Box(-45, -22.5, 45, 45), V.Box(3, 4, 3.5, 4.5), V.Box(20, 0, 10, 5), V.Box(-180, -90, 0, 0)]


@pytest.fixture(scope="module")
def places(spark):
    rng = random.Random(3)
    rows = [(f"{rng.random():.12f}", f"n{k}", rng.choice("abc"), None, rng.uniform(-180, 180), rng.uniform(-90, 90)) for k in range(3000)]
    rows += [(f"e{k}", "edge", "a", None, x, y) for k, (x, y) in enumerate([(180.0, 90.0), (-180.0, -90.0), (0.0, 0.0), (45.0, 45.0), (-45.0, -22.5)])]
    return spark.createDataFrame(rows, "id string, name string, category string, photo_url string, lng double, lat double").cache()


def views(tiles, places, monkeypatch=None):
    for box in BOXES:
        for category in (None, "a", ""):
            got = [tuple(r) for r in T.far_view(tiles, places, box, 3, category).collect()]
            assert got == [tuple(r) for r in V.viewport(places, box, 3, category).collect()], (box, category)


@pytest.mark.parametrize("limit", [500, 20])
def test_far_views_are_those_of_all_places(spark, places, monkeypatch, tmp_path, limit):
    for module in (T, V):
        monkeypatch.setattr(module, "FAR_LIMIT", limit)
    T.pyramid(places).write.parquet(f"{tmp_path}/one")
    tiles = spark.read.parquet(f"{tmp_path}/one")
    assert tiles.groupBy(*T.GROUP).count().where(F.col("count") > limit).count() == 0
    views(tiles, places)
    changed = places.where("substring(id, 4, 1) IN ('1', '5')").withColumn("category", F.when(F.col("category") == "a", "b").otherwise("a"))
    fresh = changed.limit(1).withColumn("id", F.lit("0 first"))
    written = changed.unionByName(fresh)
    now = places.join(written.select("id"), "id", "left_anti").select(places.columns).unionByName(written)
    after = T.refreshed(tiles, now, written)
    key = lambda df: sorted(map(str, df.select(*T.GROUP, "id").collect()))
    assert key(after) == key(T.pyramid(now))
    views(after, now)


def test_each_level_reads_no_more_than_the_first_places_of_the_one_below(spark, places, monkeypatch):
    monkeypatch.setattr(T, "FAR_LIMIT", 5)
    seen, real = [], T.first_of

    def counted(rows):
        out = real(rows)
        seen.append((rows.count(), "RebalancePartitions" in out._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(T, "first_of", counted)
    tiles = T.pyramid(places)
    sizes = {r.level: r["count"] for r in tiles.groupBy("level").count().collect()}
    assert seen == [(places.count(), True)] + [(sizes[n + 1], True) for n in reversed(range(T.LEVELS - 1))]
    assert sizes[0] == 15


def test_the_world_reads_the_pyramid_alone(places):
    plan = T.far_view(T.pyramid(places.limit(0)), places, BOXES[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") <= 1
    with pytest.raises(ValueError, match="zoom"):
        T.far_view(T.pyramid(places), places, BOXES[1], 9)
    assert T.covered(V.Box(-46, -24, 46, 46))[1] and T.covered(V.Box(1, 1, 1.1, 1.1))[1] == []


def test_files_cover_small_areas(spark, places, tmp_path):
    """Of 32 files few overlap a box, as their statistics tell a reader."""
    path = f"{tmp_path}/near"
    places.withColumn("cell", T.cell_key()).repartitionByRange(32, "cell").sortWithinPartitions("cell").write.parquet(path)
    box, hit, n = V.Box(10, 10, 40, 40), 0, 0
    for file in Path(path).glob("part-*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i).statistics for i in range(meta.num_columns)}
        hit += at["lng"].min <= box.east and at["lng"].max >= box.west and at["lat"].min <= box.north and at["lat"].max >= box.south
        n += 1
    assert n >= 24 and hit <= 6
