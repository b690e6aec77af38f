"""Trailing debounce: of a burst of values the last, once a gap of quiet follows it.

The application debounces by timers in a browser; session windows over event time are an
analogue of our choosing, with the same result where events come in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scan import with_runs

#: Gaps of the fetch and of the save of a viewport.
FETCH_GAP, SAVE_GAP = "250 milliseconds", "2 seconds"


def debounce(events: DataFrame, gap: str, key: str = "user_id", ts: str = "ts", values: tuple[str, ...] = ("value",), tie: str | None = None) -> DataFrame:
    """key, ts of the last event, n events and the last values of every session; on a stream after ``with_watermark``."""
    order = F.struct(ts, *([tie] if tie else []))
    return (
        events.groupBy(key, F.session_window(ts, gap).alias("session"))
        .agg(
            F.max(ts).alias("last_ts"),
            F.count("*").alias("n"),
            *[F.max_by(v, order).alias(v) for v in values],
        )
        .drop("session")
    )


def debounce_table(events: DataFrame, gap: str, key: str = "user_id", ts: str = "ts", values: tuple[str, ...] = ("value",), tie: str | None = None, parts: int | None = None) -> DataFrame:
    """The same on a table, where a key with most of the events is split (``scan``) and sessions are partial sums.

    An event exactly a gap after another opens a session, as a timer has fired by then; ``session_window`` joins the two.
    """
    order = [ts, *([tie] if tie else [])]
    quiet = F.col(ts) - F.col("_last") >= F.expr(f"INTERVAL '{gap}'")
    runs = with_runs(events.select(key, *order, *values).where(F.col(ts).isNotNull()), key, order, F.col(ts), quiet, parts)
    return (
        runs.groupBy(key, "_run")
        .agg(F.max(ts).alias("last_ts"), F.count("*").alias("n"), *[F.max_by(v, F.struct(*order)).alias(v) for v in values])
        .drop("_run")
    )


def debounced_stream(events: DataFrame, gap: str = SAVE_GAP, lateness: str = "10 seconds", **kwargs) -> DataFrame:
    """The same on a stream: sessions come out, once each, when the watermark has passed them; later events are dropped."""
    return debounce(events.withWatermark(kwargs.get("ts", "ts"), lateness), gap, **kwargs)


def save_stream(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand every finished batch to ``write`` (an upsert, say); a batch that is retried comes with the same number."""
    return stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
