"""Preferences from a live log of patches: state of each user, saved once the user has been quiet for a while.

The state holds, for every field, the last patch that had it (by ts, then event_id), so patches may arrive in any order
within the watermark's delay and the state comes out as ``users.fold_preferences`` tells it. A timer at the last patch plus the gap hands
the row to the sink; a patch before that puts it off. Patches older than the watermark are dropped, as Spark drops late rows.
A row costs the state far more than a column of Arrow, so patches that change nothing beside the others of their batch are
left out before it.
The sink keeps each batch under its number, so a batch that is run again replaces itself, and a restart from the checkpoint
loses and doubles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..schemas import PREFERENCES
from ..sources.sinks import folders_in, remove

#: Fixed value: quiet time before a viewport is saved, in milliseconds.
GAP_MS = 2000
#: Spark's settings for state with timers.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Rows that a task of ``effective`` gathers before it looks for those that count, and the most that it holds back.
GATHERED, HELD = 100_000, 500_000

FIELDS = ["basemap", "center", "zoom"]
STATE = (
    "basemap_at bigint, basemap_event bigint, basemap string, center_at bigint, center_event bigint, lng double, lat double,"
    " zoom_at bigint, zoom_event bigint, zoom double, last_at bigint, timer bigint"
)
SAVED = "user_id string, basemap_id string, last_center_lng double, last_center_lat double, last_zoom double, at bigint"


class PreferenceState(StatefulProcessor):
    """Merges the patches of a user and hands the preferences back when the user's timer fires."""

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("preferences", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0] is None:  # a heartbeat: a filter before would be moved ahead of the watermark
            return iter(())
        b_at, b_event, basemap, c_at, c_event, lng, lat, z_at, z_event, zoom, last, former = self.state.get() or (None,) * 12
        for r in rows:
            order = (r.at, r.event_id)
            if r.has_basemap and (b_at is None or order > (b_at, b_event)):
                (b_at, b_event), basemap = order, r.basemap_id
            if r.has_center and (c_at is None or order > (c_at, c_event)):
                (c_at, c_event), lng, lat = order, r.lng, r.lat
            if r.has_zoom and (z_at is None or order > (z_at, z_event)):
                (z_at, z_event), zoom = order, r.last_zoom
            last = r.at if last is None else max(last, r.at)
        now = timerValues.getCurrentWatermarkInMs()
        timer = max(last // 1000 + self.gap_ms, now + 1)  # late but not dropped: at once
        if timer != former:
            if former is not None and former > now:  # up to now it may have fired; if not, it finds another timer in the state
                self.handle.deleteTimer(former)
            self.handle.registerTimer(timer)
        self.state.update((b_at, b_event, basemap, c_at, c_event, lng, lat, z_at, z_event, zoom, last, timer))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        _, _, basemap, _, _, lng, lat, _, _, zoom, last, timer = self.state.get()
        if timer == expiredTimerInfo.getExpiryTimeInMs():
            yield Row(user_id=key[0], basemap_id=basemap, last_center_lng=lng, last_center_lat=lat, last_zoom=zoom, at=last)

    def close(self) -> None:
        pass


def counting(patches: pa.Table) -> pa.Table:
    """Of each user the last patch of all and the last one of each field; at most four rows."""
    patches = patches.take(pc.sort_indices(patches, sort_keys=[("at", "ascending"), ("event_id", "ascending")], null_placement="at_start"))
    place = pa.array(np.arange(len(patches)))
    none = pa.scalar(None, pa.int64())
    places = {c: pc.if_else(patches[c], place, none) for c in ("has_basemap", "has_center", "has_zoom")} | {"last": place}
    found = pa.table({"user_id": patches["user_id"], **places}).group_by("user_id", use_threads=False).aggregate([(c, "max") for c in places])
    kept = pc.unique(pa.chunked_array([x for c in places for x in found[f"{c}_max"].chunks], pa.int64()))
    return patches.take(kept.drop_null())


def effective(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Patches without those that later ones of their user override in every field.

    A patch is older than what overrides it, so if the watermark drops the later one, it would have dropped both.
    """
    held, fresh, n = None, [], 0

    def merged() -> pa.Table:
        return counting(pa.concat_tables(([held] if held else []) + [pa.Table.from_batches(fresh)]))

    for batch in batches:
        fresh.append(batch)
        n += batch.num_rows
        if n >= max(GATHERED, held.num_rows if held else 0):
            held, fresh, n = merged(), [], 0
            if held.num_rows > HELD:
                yield from held.to_batches()
                held = None
    if fresh:
        held = merged()
    if held:
        yield from held.to_batches()


def saved_preferences(patches: DataFrame, gap_ms: int = GAP_MS, lateness: str = "10 seconds") -> DataFrame:
    """A stream of patches to a stream of preferences rows, one each time a user falls quiet.

    A row without a user_id or without ts changes nothing; one without a user_id moves the watermark on.
    """
    center = [F.col("last_center").isNotNull().alias("has_center"), F.get("last_center", F.lit(0)).alias("lng"), F.get("last_center", F.lit(1)).alias("lat")]
    timed = patches.where("ts IS NOT NULL").select(
        "user_id", "ts", F.unix_micros("ts").alias("at"), "event_id", "has_basemap", "basemap_id", *center, "has_zoom", "last_zoom"
    )
    # the last patch of every user stays, so the watermark is that of all patches
    rows = timed.repartition("user_id").mapInArrow(effective, timed.schema).withWatermark("ts", lateness)
    saved = rows.groupBy("user_id").transformWithState(
        statefulProcessor=PreferenceState(gap_ms), outputStructType=SAVED, outputMode="append", timeMode="EventTime"
    )
    return saved.select(*[c for c in PREFERENCES.fieldNames() if c != "updated_at"], F.timestamp_micros("at").alias("updated_at"))


class PreferenceSink:
    """Preferences as folders: batch=N, a batch's rows, and base=N, all users up to that batch."""

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: DataFrame, number: int) -> None:
        """Save a batch; the same number again replaces it."""
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def parts(self, spark: SparkSession) -> tuple[int, list[str]]:
        """The number of the last base (-1: none), and the folders that make up the table."""
        names = folders_in(spark, self.path, complete=True)
        numbers = {kind: sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=")) for kind in ("base", "batch")}
        base = numbers["base"][-1] if numbers["base"] else -1
        return base, [f"base={base}"] * (base >= 0) + [f"batch={n}" for n in numbers["batch"] if n > base]

    def table(self, spark: SparkSession) -> DataFrame:
        """The newest row of each user."""
        _, parts = self.parts(spark)
        if not parts:
            return spark.createDataFrame([], PREFERENCES)
        frames = [
            spark.read.schema(PREFERENCES).parquet(f"{self.path}/{p}").withColumn("batch", F.lit(n)) for n, p in enumerate(parts)
        ]
        every = frames[0]
        for frame in frames[1:]:
            every = every.unionByName(frame)
        newest = every.groupBy("user_id").agg(F.max_by(F.struct(*PREFERENCES.fieldNames()), F.struct("updated_at", "batch")).alias("row"))
        return newest.select("row.*")

    def compact(self, spark: SparkSession) -> None:
        """Make a base of all batches so far, and delete those. Readers that began before may have to begin again."""
        base, parts = self.parts(spark)
        last = max((int(p.split("=")[1]) for p in parts), default=-1)
        if last > base:
            self.table(spark).write.mode("overwrite").parquet(f"{self.path}/base={last}")
            for part in parts:
                remove(spark, f"{self.path}/{part}")


@contextmanager
def state_with_timers(spark: SparkSession):
    """Queries started within keep their state in RocksDB, which timers ask for."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def keep_preferences(patches: DataFrame, sink: PreferenceSink, checkpoint: str, gap_ms: int = GAP_MS, lateness: str = "10 seconds", **trigger) -> StreamingQuery:
    """Start saving a stream of patches; it goes on from its checkpoint. trigger: as of ``DataStreamWriter.trigger``."""
    with state_with_timers(patches.sparkSession):
        writer = saved_preferences(patches, gap_ms, lateness).writeStream.outputMode("append").foreachBatch(sink.write)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
