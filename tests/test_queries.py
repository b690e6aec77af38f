from __future__ import annotations

import pytest
from oracle import compare

from waymark import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, sf, name):
    compare(spark, name, queries.QUERIES[name], queries.SQL[name], sf)


@pytest.mark.parametrize("name", sorted(queries.QUERIES.keys() - queries.SQL.keys()))
def test_query_without_sql_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["id", "lng", "lat", "name", "category", "photo_url"]
    assert queries.QUERIES.keys() <= __spark_entry__.queries().keys()
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_filters_and_columns_reach_the_scan(spark, sf, tmp_path):
    from waymark.operators import viewport as V
    from waymark.sources import derived

    path = str(tmp_path / "places")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    V.near(derived.places(spark, sf)).write.parquet(path)
    plan = V.viewport(spark.read.parquet(path), V.Box(0, 0, 10, 10), 8, "BUILDING")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lng,0.0)" in plan and "EqualTo(category,BUILDING)" in plan
    assert "description" not in plan.split("ReadSchema")[1].split("\n")[0]
    world = V.viewport(spark.read.parquet(path), V.Box(-180, -90, 180, 90), 8)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lng" not in world
