from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from waymark.operators import scan
from waymark.operators import users as U
from waymark.streaming.debounce import debounce, debounce_table

LOG = "user_id string, ts timestamp, event_id bigint, has_basemap boolean, basemap_id string, last_center array<double>, has_zoom boolean, last_zoom double"


@pytest.fixture(scope="module")
def patches(spark):
    """One user with nine tenths of the patches, some users with a few, and rows of no user."""
    n, draw = F.col("id"), F.abs(F.xxhash64("id"))
    rows = spark.range(20_000).select(
        F.when(n % 10 > 0, "hot").when(n % 50 > 0, F.concat(F.lit("u"), (draw % 300).cast("string"))).alias("user_id"),
        F.timestamp_seconds(1_700_000_000 + (draw % 4000)).alias("ts"),
        n.alias("event_id"),
        (draw % 97 == 0).alias("has_basemap"),
        F.when(draw % 97 == 0, F.when(draw % 5 > 0, (draw % 7).cast("string"))).alias("basemap_id"),
        F.when(draw % 1999 == 3, F.array((draw % 360).cast("double"), F.lit(1.0))).alias("last_center"),
        (draw % 101 == 0).alias("has_zoom"),
        F.when(draw % 2 == 0, (draw % 20).cast("double")).alias("last_zoom"),
    )
    return rows.cache()


def plain_history(patches):
    by = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = lambda present, value: F.last(F.when(present, F.struct(value.alias("v"))), ignorenulls=True).over(by)["v"]
    return patches.select(
        "user_id",
        "event_id",
        last(F.col("has_basemap"), F.col("basemap_id")).alias("basemap_id"),
        last(F.col("last_center").isNotNull(), F.col("last_center")).alias("last_center"),
        last(F.col("has_zoom"), F.col("last_zoom")).alias("last_zoom"),
    )


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("parts", [1, 13])
def test_history_is_that_of_one_window(patches, parts):
    assert rows_of(U.preference_history(patches, parts)) == rows_of(plain_history(patches))


def test_a_hot_key_is_split_evenly(spark, patches):
    s = scan.Segments(patches, "user_id", ["ts", "event_id"], 12)
    sizes = [r["count"] for r in s.rows.groupBy("user_id", scan.SEGMENT).count().where("user_id = 'hot'").collect()]
    assert len(sizes) >= 9 and max(sizes) < 20_000 / 12 * 2
    plan = U.preference_history(patches, 12)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("_segment" in line or "_fold" in line or "_folded" in line for line in windows)


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_toggles_are_those_of_one_window(spark, parts):
    rng = random.Random(parts)
    rows, n = [], 0
    for user, clicks in (("hot", 900), ("b", 40), (None, 30), ("c", 1)):
        place = None
        for _ in range(clicks):
            if rng.random() < 0.15 or user == "c":
                place = rng.choice(["x", "y", None])
            rows.append((user, n // 2, n, place))
            n += 1
    rows += [("one", t, 10_000 + t, "same") for t in range(500)]  # a run over many segments
    clicks = spark.createDataFrame(rows, "user_id string, ts bigint, event_id bigint, place string")
    want, last, nth = {}, {}, {}
    for user, _, event, place in rows:
        nth[user] = nth[user] + 1 if user in last and last[user] == place else 1
        last[user] = place
        want[event] = place if nth[user] % 2 else None
    assert {r.event_id: r.selected for r in U.toggled(clicks, parts).collect()} == want


@pytest.mark.parametrize("parts", [1, 7])
def test_debounced_tables_are_session_windows(patches, parts):
    events = patches.withColumn("value", F.col("event_id") * 2)
    for gap in ("1500 milliseconds", "6500 milliseconds"):  # no two events lie a gap apart
        one = debounce_table(events, gap, tie="event_id", parts=parts)
        two = debounce(events.where("user_id IS NOT NULL"), gap, tie="event_id")
        assert rows_of(one.where("user_id IS NOT NULL")) == rows_of(two)


def test_empty_rows_and_reserved_names(spark, patches):
    assert U.preference_history(patches.limit(0)).count() == 0
    with pytest.raises(ValueError, match="_segment"):
        scan.Segments(patches.withColumn("_segment", F.lit(1)), "user_id", ["ts"])
