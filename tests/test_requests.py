from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from waymark.operators import users as U
from waymark.plans import imports
from waymark.schemas import PLACES
from waymark.sources import derived as D, layout

ROW = "idx bigint, name string, category string, lng double, lat double"


def test_reasons_and_policies(spark):
    rows = spark.createDataFrame(
        [(0, "a", "x", 1.0, 1.0), (1, None, "x", 9.0, 9.0), (2, "long", None, 2.0, 2.0), (3, "long", "x", 1.0, 1.0), (4, "b", "x", 5.0, 1.0), (5, "c", "x", None, 1.0)], ROW
    )
    target = spark.createDataFrame([(5.0, 1.0), (5.0, 1.0), (1.0, 2.0), (None, 1.0)], "lng double, lat double")
    checks = [imports.Check("name: too long", F.length("name") < 4), imports.Check("lng: odd", F.col("lng") != 9)]
    told = imports.with_reason(rows, target, checks, unique=[["lng", "lat"]])
    assert told.columns == [*rows.columns, "reason"] and told.count() == 6
    got = {r.idx: r.reason for r in told.collect()}
    assert got == {0: None, 1: "name: missing", 2: "category: missing", 3: "name: too long", 4: "lng, lat: already there", 5: "lng: missing"}
    ids = lambda df: sorted(r.idx for r in df.collect())
    good, bad = imports.admit(told)
    assert ids(good) == [0] and ids(bad) == [1, 2, 3, 4, 5] and "reason" not in good.columns
    good, bad = imports.admit(told, "skip")
    assert ids(good) == [0] and ids(bad) == [1, 2, 3, 5]
    with pytest.raises(imports.Rejected, match="row 1: name: missing"):
        imports.admit(told, "abort")
    assert ids(imports.admit(told.where("idx = 0"), "abort")[0]) == [0]
    with pytest.raises(ValueError, match="policy"):
        imports.admit(told, "other")
    assert imports.with_reason(rows.limit(0), target, checks, unique=[["lng", "lat"]]).count() == 0
    assert all(f.name in PLACES.fieldNames() for f in PLACES if not f.nullable)


def test_buckets_are_joined_without_an_exchange(spark, sf, tmp_path):
    users = layout.bucketed(D.users(spark, sf), "users", "id", f"{tmp_path}/users", 8)
    saved = layout.bucketed(U.fold_preferences(D.preference_patches(spark, sf)), "preferences", "user_id", f"{tmp_path}/preferences", 8)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sessions = U.sessions(users, saved)
        plan = sessions._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        orphans = saved.join(users.select(F.col("id").alias("user_id")), "user_id", "left_anti")
        assert "Exchange" not in orphans._jdf.queryExecution().executedPlan().toString()
        plain = U.sessions(D.users(spark, sf), U.fold_preferences(D.preference_patches(spark, sf)))
        assert sorted(map(str, sessions.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
