"""Mix sources to target weights by fractional repetition.

Tokens are aggregated per source, each source gets a repetition rate, and every
document is emitted floor(rate) times plus one copy by a hash-seeded Bernoulli draw
whose probability is the fraction of the rate.

Defined results:
- null text has size 0; null source is a source of its own, ranked last;
- an empty source (size 0) has target 0, rate 0 and no copies;
- the draw is seeded by doc_id (by the text where doc_id is null), so reruns agree and
  repeated rows get equal decisions;
- an empty table gives an empty result; further input columns are kept by ``emit``. The
  columns added are named ``mix_*``, and an input column of such a name is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, cut, table, text_or_empty

#: The rate table is broadcast up to so many sources and so many bytes of names.
MAX_BROADCAST_SOURCES = 10_000
MAX_BROADCAST_BYTES = 1_000_000
#: Beyond that it is joined by source and one of so many salts: a source may hold a third of all rows.
SALTS = 64


#: Columns that planning and emitting add, or use on the way.
ADDED = ["size", "source", "source_size", "target", "rate", "copies", "copy", "salt", "salt_r"]
ADDED = [f"mix_{name}" for name in ADDED]


def size_of(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def rates(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per source: source_size, target and rate.

    Sources in code point order take the ``weights`` in turn and share the sum of all
    sizes. A target stops at ``cap`` times its source's size, and the excess is shared
    again. In the end every open source gets weight * level for one common level: with
    sources ordered by cap / weight, the level is the largest one at which the first open
    source stays below its cap. The windows run over one row per source, after
    aggregation, not over documents.
    """
    totals = sizes.groupBy(F.col("source").alias("mix_source")).agg(F.sum("mix_size").alias("mix_source_size"))
    by_name = W.orderBy(F.col("mix_source").asc_nulls_last())
    by_ratio = W.orderBy("ratio", F.col("mix_source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights) + 1
    ranked = (
        totals.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), position))
        .withColumn("cap", F.col("mix_source_size") * cap)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
    )
    capped_before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing))
    everything = W.partitionBy()
    level = (F.sum("mix_source_size").over(everything) - capped_before).cast("double") / open_weight.cast("double")
    levelled = ranked.withColumn("level", level)
    shared = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    return levelled.withColumn(
        "mix_target", F.least(F.col("cap").cast("double"), shared * F.col("weight"))
    ).select(
        "mix_source",
        "mix_source_size",
        "mix_target",
        F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size"))
        .otherwise(0.0)
        .alias("mix_rate"),
    )


def draw(seed: int) -> Column:
    """A number in [0, 1), the same for the same document and seed."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 7) -> DataFrame:
    """Every row of ``docs`` once, with mix_size, mix_source_size, mix_target, mix_rate, mix_copies."""
    sized = docs.drop(*ADDED).withColumn("mix_size", size_of())
    per_source = cut(rates(sized.select("source", "mix_size"), weights, cap), "rates")
    n, name_bytes = per_source.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("mix_source")), F.lit(0))).first()
    if n <= MAX_BROADCAST_SOURCES and name_bytes <= MAX_BROADCAST_BYTES:
        joined = sized.join(F.broadcast(per_source), F.col("source").eqNullSafe(F.col("mix_source")))
    else:
        salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS))
        left = sized.withColumn("mix_salt", salt)
        right = per_source.withColumn("mix_salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = left.join(
            right, F.col("source").eqNullSafe(F.col("mix_source")) & (F.col("mix_salt") == F.col("mix_salt_r"))
        ).drop("mix_salt", "mix_salt_r")
    whole = F.floor("mix_rate")
    extra = (draw(seed) < F.col("mix_rate") - whole).cast("long")
    return joined.withColumn("mix_copies", whole + extra).drop("mix_source")


def emit(planned: DataFrame) -> DataFrame:
    """The mix itself: each planned row mix_copies times, numbered by mix_copy from 1."""
    return planned.where(F.col("mix_copies") > 0).withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = plan_mix(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
        "source",
        F.col("mix_copies").alias("copies"),
    )


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, 3 * source_size AS cap,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM totals),
levels AS (
  SELECT *,
         CAST((SELECT sum(source_size) FROM totals) - coalesce(sum(cap) OVER (
           ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER (
           ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM ranked),
rated AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), weight * (SELECT max(level) FROM levels WHERE level * weight <= cap)) AS target
  FROM levels),
planned AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, s.source,
         CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('7:' || coalesce(CAST(s.doc_id AS VARCHAR), s.text, '')), 1, 13) AS BIGINT)
              AS DOUBLE) / 4503599627370496.0 AS u
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken,
       source,
       CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS copies
FROM planned
"""
