"""Running values of ordered rows, key by key, without a task a key.

Rows are split into segments by ranges of (key, order), so a key with most of the rows has many segments, as
evenly filled as the others. Each segment is folded by itself; of every segment that goes on with a key from the one
before, a carry tells what its rows would have found. There is at most one such a segment, so
the carries are few and are broadcast, and windows over a segment do the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.window import WindowSpec

from ..sources.scratch import scratch

SEGMENT = "_segment"


class Segments:
    """Rows split by (key, order), written to the shared folder so that a lost executor doesn't change the split.

    Rows of equal key and order stay together. A null key is a key of its own; null orders come first.
    """

    def __init__(self, rows: DataFrame, key: str, order: list[str], parts: int | None = None):
        if SEGMENT in rows.columns:
            raise ValueError(f"a column of the rows is named {SEGMENT}")
        ranges = rows.repartitionByRange(parts, key, *order) if parts else rows.repartitionByRange(key, *order)
        path = scratch(rows.sparkSession, "segments")
        ranges.withColumn(SEGMENT, F.spark_partition_id()).write.parquet(path)
        self.key, self.order = key, order
        self.rows = rows.sparkSession.read.parquet(path)

    def window(self) -> WindowSpec:
        """The rows of a segment and key, in order."""
        return W.partitionBy(self.key, SEGMENT).orderBy(*self.order)

    def running(self) -> WindowSpec:
        return self.window().rowsBetween(W.unboundedPreceding, W.currentRow)

    def place(self) -> Column:
        """The order of a row, to be given to max_by and min_by."""
        return F.struct(*self.order)

    def carried(self, rows: DataFrame, folds: dict[str, Column], carries: dict[str, Column] | list[dict[str, Column]]) -> DataFrame:
        """``rows`` with the columns of ``carries``.

        folds: aggregates of a key's rows in a segment. carries: window expressions over the folds, made with ``before()`` and ``so_far()``; a list
        of them is worked off in turn, the later ones with the columns of the earlier. They are null in a key's first segment.
        """
        steps = [carries] if isinstance(carries, dict) else carries
        found = rows.groupBy(self.key, SEGMENT).agg(*[c.alias(n) for n, c in folds.items()], F.lit(True).alias("_folded"))
        found = found.withColumn("_later", F.lag("_folded").over(self.segments()).isNotNull())
        for step in steps:
            found = found.withColumns(step)
        names = [n for step in steps for n in step]
        few = found.where("_later").select(F.col(self.key).alias("_key"), F.col(SEGMENT).alias("_at"), *names)  # one a segment at most
        same = (F.col(SEGMENT) == F.col("_at")) & F.col(self.key).eqNullSafe(F.col("_key"))
        return rows.join(F.broadcast(few), same, "left").drop("_key", "_at")

    def segments(self) -> WindowSpec:
        return W.partitionBy(self.key).orderBy(SEGMENT)

    def before(self) -> WindowSpec:
        """All segments of the key ahead of a segment."""
        return self.segments().rowsBetween(W.unboundedPreceding, -1)


def running_last(rows: DataFrame, key: str, order: list[str], values: dict[str, Column], parts: int | None = None) -> DataFrame:
    """``rows`` with, for each of ``values``, the last one that isn't null so far in the order of the key's rows."""
    s = Segments(rows, key, order, parts)
    own = {f"_{n}": c for n, c in values.items()}
    folds = {f"_{n}_fold": F.max_by(c, F.when(c.isNotNull(), s.place())) for n, c in values.items()}
    carries = {f"_{n}_carry": F.last(f"_{n}_fold", ignorenulls=True).over(s.before()) for n in values}
    out = s.carried(s.rows, folds, carries)
    out = out.withColumns({n: F.last(c, ignorenulls=True).over(s.running()) for n, c in own.items()})
    out = out.withColumns({n: F.coalesce(f"_{n}", f"_{n}_carry") for n in values})
    return out.drop(SEGMENT, *own, *carries)


def with_runs(rows: DataFrame, key: str, order: list[str], same: Column, fresh: Column, parts: int | None = None) -> DataFrame:
    """``rows`` with _run, the number of the key's runs so far, and _nth, the place of the row in its run, both from 1.

    same: what a row leaves for the next one to look at; fresh: whether a row opens a run, told from its columns and ``_last``, the
    ``same`` of the row before. A key's first row always opens one.
    """
    s = Segments(rows.withColumn("_same", same), key, order, parts)
    lasts = s.carried(s.rows, {"_end": F.max_by(F.struct("_same"), s.place())}, {"_end_carry": F.lag("_end").over(s.segments())})
    at = F.coalesce(F.lag(F.struct("_same")).over(s.window()), F.col("_end_carry"))
    marked = lasts.withColumn("_before", at).withColumn("_last", F.col("_before._same"))
    marked = marked.withColumn("_fresh", F.col("_before").isNull() | fresh).withColumn("_row", F.row_number().over(s.window()))
    opened = F.last(F.when(F.col("_fresh"), F.col("_row")), ignorenulls=True).over(s.running())
    marked = marked.withColumn("_opened", opened).withColumn("_runs", F.sum(F.col("_fresh").cast("long")).over(s.running()))
    ahead = F.coalesce(F.sum("_rows").over(s.before()), F.lit(0))
    out = s.carried(
        marked,
        {"_rows": F.count("*"), "_run_count": F.sum(F.col("_fresh").cast("long")), "_last_opened": F.max(F.when(F.col("_fresh"), F.col("_row")))},
        [
            {"_ahead": ahead, "_runs_carry": F.sum("_run_count").over(s.before())},
            {"_opened_at": F.col("_ahead") + F.col("_last_opened")},
            {"_open_carry": F.last("_opened_at", ignorenulls=True).over(s.before()) - F.col("_ahead")},
        ],
    )
    out = out.withColumn("_run", F.col("_runs") + F.coalesce("_runs_carry", F.lit(0)))
    out = out.withColumn("_nth", F.col("_row") - F.coalesce("_opened", "_open_carry") + 1)
    return out.select(*rows.columns, "_run", "_nth")
