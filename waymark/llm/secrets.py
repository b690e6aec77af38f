"""Secret scans over an incremental blob ledger.

Every text version is addressed by the SHA-256 of its content. A ledger table remembers
which (blob, rule version) pairs were scanned and with what findings; only unseen pairs
are scanned, and the findings are joined back to all rows (paths) that hold
the blob. Spans are in code points, end exclusive.

No text is ever shuffled: what moves are the addresses of blobs and their spans. Rows to scan
are chosen where they lie:

- no unseen blob: no text is read again;
- up to BROADCAST_ROWS unseen blobs: one row of each, told by a broadcast table of short keys;
- more: rows whose key is marked in broadcast bitmaps of all unseen blobs. About one seen blob in sixteen is marked by
  chance, and copies of an unseen blob are scanned where they lie; that costs time, no moved texts, and the
  ledger still takes each unseen blob once.

Defined results:
- null text is the empty text; empty texts and texts without findings have no spans;
- texts of any length, with any number of findings, are scanned whole;
- repeated rows and copies of a text each get their row;
- a blob that stands several times in the ledger, after a repeated append or two scans at once, counts once;
- a null doc_id keeps its row; an empty table gives no rows;
- further input columns are ignored by the scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, fresh_path, table, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A pattern without lookaround; of its matches those stay whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    #: A literal that any match holds: texts without it aren't searched.
    literal: str | None = None


#: The three base patterns. The bounded forms of access and hex match the
#: same spans as the open ones with a length check, since both match whole runs.
BASE = (
    Rule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}", literal="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds of this rule set; they add spans.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", literal="PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", literal="gh"),
)
RULES = BASE + MORE
#: Raise it with any change to the rules: blobs are then scanned anew.
RULE_VERSION = "1"

#: Bitmaps of unseen blobs have so many bits a blob, and so many bits in all at most (64 MB).
BITS_PER_BLOB = 16
MOST_BITS = 1 << 29
BITMAP_BITS = 8 * 4096

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once and used several times."""
    return F.element_at(F.transform(F.array(value), then), 1)


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """The rule's spans in ``text``: match lengths and the lengths of what lies between give the offsets."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    lengths = F.transform(whole, lambda m: F.length(m).cast("bigint"))
    checked = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))
    parts = F.arrays_zip(gaps.alias("gap"), lengths.alias("len"), checked.alias("value"))

    def walked(part: Column) -> Column:
        return part["gap"] + F.coalesce(part["len"], F.lit(0))

    def within(chunk: Column, begin: Column) -> Column:
        """The spans of some parts in a row, the first of which begins at ``begin``."""

        def step(state: Column, part: Column) -> Column:
            start, end = state["at"] + part["gap"], state["at"] + walked(part)
            good = part["len"].isNotNull() & (F.length(part["value"]) >= rule.least)
            span = F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")
            )
            found = F.when(good, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), found.alias("spans"))

        state = F.struct(begin.alias("at"), F.array().cast(SPAN).alias("spans"))
        return F.aggregate(chunk, state, step, lambda s: s["spans"])

    def chunked(of: Column) -> Column:
        """The parts in chunks, as many as a chunk has parts: a text of n matches costs n steps and n ** 1.5 copied spans."""
        size = F.ceil(F.sqrt(F.size(of))).cast("int")
        return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.slice(of, i * size + 1, size))

    def spans(chunks: Column, lengths: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        begins = F.transform(lengths, lambda _, i: F.aggregate(F.slice(lengths, F.lit(1), i), zero, lambda a, n: a + n))
        return F.flatten(F.zip_with(chunks, begins, within))

    def summed(chunks: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.transform(chunks, lambda c: F.aggregate(c, zero, lambda at, part: at + walked(part)))

    found = bound(bound(parts, chunked), lambda chunks: bound(summed(chunks), lambda lengths: spans(chunks, lengths)))
    hit = F.regexp_like(text, pattern)
    if rule.literal:
        hit = F.contains(text, F.lit(rule.literal)) & hit
    return F.when(hit, found).otherwise(F.array().cast(SPAN))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, text) -> (blob, spans), spans by start, then by the order of the rules."""
    every = F.concat(*[spans_of(F.col("text"), rule, rank) for rank, rule in enumerate(rules)])
    return blobs.select("blob", F.array_sort(every).alias("spans"))


def marked(rows: DataFrame, keys: DataFrame, n: int) -> DataFrame:
    """The rows whose ``quick`` is marked in bitmaps of the ``n`` keys' ones: all that are among them, and some by chance."""
    bits = min(max(BITMAP_BITS, 1 << (BITS_PER_BLOB * n - 1).bit_length()), MOST_BITS)
    place = F.pmod("quick", F.lit(bits)) + 1  # bitmaps count from 1
    bitmaps = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substr("bitmap", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_there = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    found = rows.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place) == F.col("bucket"))
    return found.where(set_there).select(rows.columns)


def seen_blobs(spark: SparkSession, ledger_path: str, version: str) -> DataFrame | None:
    """blob, spans of the ledger's rows of a rule version, or None where there is no ledger yet."""
    if not ledger_exists(spark, ledger_path):
        return None
    ledger = spark.read.schema(f"blob string, spans {SPAN}, rule_version string").parquet(ledger_path)
    return ledger.where(F.col("rule_version") == version).select("blob", "spans")


def rows_to_scan(docs: DataFrame, unseen: DataFrame, n: int) -> DataFrame:
    """(blob, text) of the rows to scan, chosen in place; every unseen blob is among them."""
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("quick", F.xxhash64("text"))
    if n <= BROADCAST_ROWS:
        keys = unseen.select(F.col("quick").alias("key"), "first_id")
        rows = rows.join(F.broadcast(keys), (F.col("quick") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    else:
        rows = marked(rows, unseen, n)
    return rows.select(F.sha2(F.col("text").cast("binary"), 256).alias("blob"), "text")


def scan(
    docs: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as doc_id, blob, spans; the ledger grows by what was unseen.

    The ledger has a row per (blob, rule_version) with its spans.
    """
    spark = docs.sparkSession
    text = text_or_empty()
    paths = cut(
        docs.select("doc_id", F.sha2(text.cast("binary"), 256).alias("blob"), F.xxhash64(text).alias("quick")), "paths"
    )
    wanted = paths.groupBy("blob").agg(F.min("doc_id").alias("first_id"), F.min("quick").alias("quick"))
    seen = seen_blobs(spark, ledger_path, version)
    if seen is not None:
        wanted = wanted.join(seen.select("blob"), "blob", "left_anti")
    unseen = cut(wanted, "unseen")
    n = unseen.count()
    if n or seen is None:
        found = scan_blobs(rows_to_scan(docs, unseen, n), rules).dropDuplicates(["blob"])
        fresh = found.join(unseen.select("blob"), "blob", "left_semi")
        fresh.withColumn("rule_version", F.lit(version)).write.mode("append").parquet(ledger_path)
    findings = seen_blobs(spark, ledger_path, version).where(F.size("spans") > 0).dropDuplicates(["blob"])
    return paths.join(findings, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")
    )


def ledger_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against a ledger of its own, so that a rerun scans everything again."""
    found = scan(table(spark, sf_dir, "documents"), fresh_path(spark, "ledger"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _sql_spans(rank: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, row_no, {rank} AS rank, '{rule.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, v, g FROM (
    SELECT doc_id, row_no, regexp_extract_all(text, '{pattern}') AS m,
           regexp_extract_all(text, '{pattern}', {rule.group}) AS v,
           regexp_split_to_array(text, '{pattern}') AS g FROM d)"""


OP1_SQL = (
    """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents),
matches AS ("""
    + " UNION ALL ".join(_sql_spans(k, r) for k, r in enumerate(RULES))
    + """),
spans AS (
  SELECT doc_id, row_no, rank, kind,
    list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
    length(m[i]) AS n
  FROM matches WHERE length(v[i]) >= CASE rank WHEN 0 THEN 6 ELSE 1 END),
agg AS (
  SELECT row_no,
    count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY row_no)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (row_no)
"""
)
