from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow as pa

from waymark.operators.users import fold_preferences
from waymark.streaming import preferences as live

PATCH = "user_id string, ts timestamp, event_id bigint, has_basemap boolean, basemap_id string, last_center array<double>, has_zoom boolean, last_zoom double"
START = datetime(2024, 1, 1)


def draw(seed, n=400, seconds=200):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        rows.append(
            (f"u{rng.randrange(12)}", START + timedelta(milliseconds=rng.randrange(seconds * 1000)), k, rng.random() < 0.3, rng.choice([None, "a", "b"]),
             rng.choice([None, None, [1.0 * k, 2.0], [3.0]]), rng.random() < 0.3, rng.choice([None, 1.0, 2.0 * k]))
        )
    return rows


def beat(seconds):
    return (None, START + timedelta(seconds=seconds), None, None, None, None, None, None)


class Replay:
    """Files that arrive one after the other; each run goes on from the checkpoint."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.sink = spark, str(folder), live.PreferenceSink(f"{folder}/saved")

    def run(self, rows, **settings):
        self.spark.createDataFrame(rows, PATCH).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(PATCH).parquet(f"{self.folder}/in")
        live.keep_preferences(stream, self.sink, f"{self.folder}/checkpoint", **settings).awaitTermination()

    def saved(self):
        return sorted(map(tuple, self.sink.table(self.spark).collect()))


def folded(spark, rows):
    return sorted(map(tuple, fold_preferences(spark.createDataFrame(rows, PATCH)).collect()))


def test_out_of_order_and_restarts_give_the_fold(spark, tmp_path):
    rows = draw(1)
    late = lambda r: r[1] + timedelta(seconds=(r[2] * 7) % 30)
    arriving = sorted(rows, key=late)
    replay = Replay(spark, tmp_path)
    for at in range(0, len(arriving), 150):
        replay.run(arriving[at : at + 150], lateness="40 seconds")
    replay.run([beat(10_000)], lateness="40 seconds")
    assert replay.saved() == folded(spark, rows)
    assert spark.conf.get(live.PROVIDER, None) != live.ROCKSDB


def test_saved_only_when_quiet_and_too_late_is_dropped(spark, tmp_path):
    replay = Replay(spark, tmp_path)
    patch = lambda user, s, n, zoom: (user, START + timedelta(seconds=s), n, False, None, None, True, zoom)
    replay.run([patch("a", 0, 1, 1.0), patch("b", 0, 2, 1.0), patch("b", 11, 3, 2.0)], lateness="10 seconds")
    assert replay.saved() == []  # the watermark is at 1 s: a's gap isn't over
    replay.run([patch("b", 12.5, 4, 3.0)], lateness="10 seconds")
    assert [(r[0], r[4]) for r in replay.saved()] == [("a", 1.0)]
    replay.run([patch("b", 60, 5, 4.0)], lateness="10 seconds")
    replay.run([patch("a", 20, 6, 9.0), patch("a", 55, 7, 5.0), beat(100)], lateness="10 seconds")  # 20 s is behind the watermark
    assert [(r[0], r[4]) for r in replay.saved()] == [("a", 5.0), ("b", 4.0)]


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    sink = live.PreferenceSink(f"{tmp_path}/saved")
    assert sink.table(spark).count() == 0
    row = lambda user, zoom, s: spark.createDataFrame([(user, "m", None, None, zoom, START + timedelta(seconds=s))], live.PREFERENCES)
    sink.write(row("a", 1.0, 0), 0)
    sink.write(row("a", 2.0, 5), 1)
    sink.write(row("b", 3.0, 1), 2)
    sink.write(row("b", 4.0, 1), 2)
    want = [("a", 2.0), ("b", 4.0)]
    assert sorted((r.user_id, r.last_zoom) for r in sink.table(spark).collect()) == want
    sink.compact(spark)
    assert sink.parts(spark) == (2, ["base=2"])
    sink.write(row("b", 4.0, 1), 2)  # once more, after its base was made
    assert sorted((r.user_id, r.last_zoom) for r in sink.table(spark).collect()) == want
    sink.write(row("a", 7.0, 9), 3)
    sink.compact(spark)
    assert sorted((r.user_id, r.last_zoom) for r in sink.table(spark).collect()) == [("a", 7.0), ("b", 4.0)]
    assert sink.parts(spark) == (3, ["base=3"])


def test_few_patches_of_a_user_reach_the_state(spark, tmp_path, monkeypatch):
    class Counting(live.PreferenceState):
        def handleInputRows(self, key, rows, timerValues):
            rows = list(rows)
            assert len(rows) <= 4, f"{len(rows)} rows of {key}"
            return live.PreferenceState.handleInputRows(self, key, rows, timerValues)

    monkeypatch.setattr(live, "PreferenceState", Counting)
    rows = draw(2, n=2000)
    replay = Replay(spark, tmp_path)
    replay.run([*rows, beat(10_000)], lateness="40 seconds")
    assert replay.saved() == folded(spark, rows)


def test_what_is_left_out_changes_nothing_wherever_the_watermark_cuts(monkeypatch):
    monkeypatch.setattr(live, "GATHERED", 50)
    monkeypatch.setattr(live, "HELD", 60)  # with 20 users some rows are handed on early
    rng = random.Random(4)
    rows = [
        {"user_id": rng.choice([None, *"abcdefghijklmnopqrs"]), "at": rng.randrange(300), "event_id": k, "has_basemap": rng.choice([True, False, False, None]),
         "has_center": rng.random() < 0.2, "has_zoom": rng.random() < 0.1}
        for k in range(3000)
    ]
    schema = pa.schema({"user_id": pa.string(), "at": pa.int64(), "event_id": pa.int64(), **{c: pa.bool_() for c in ("has_basemap", "has_center", "has_zoom")}})
    given = pa.Table.from_pylist(rows, schema)
    kept = [r for batch in live.effective(iter(given.to_batches(max_chunksize=37))) for r in batch.to_pylist()]
    assert len(kept) < 1500 and {r["event_id"] for r in kept} <= set(range(3000))

    def fold(patches, cut):
        found = {}
        for r in patches:
            for c in ("has_basemap", "has_center", "has_zoom", "at"):
                if r["at"] >= cut and (c == "at" or r[c]):
                    found[r["user_id"], c] = max(found.get((r["user_id"], c), (-1, -1)), (r["at"], r["event_id"]))
        return found

    for cut in (0, 1, 50, 150, 270, 290, 299):
        assert fold(kept, cut) == fold(rows, cut)
    assert list(live.effective(iter(given.slice(0, 0).to_batches()))) == []
    assert sum(b.num_rows for b in live.effective(iter([pa.RecordBatch.from_pylist([], schema)]))) == 0
