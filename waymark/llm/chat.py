r"""Chat formatting with Spark expressions only.

Turns are collected as structs per conversation and sorted, adjacent turns of one role
are merged by array aggregation, and the blocks are concatenated under a template:

    <s>ROLE[INST]TEXT[/INST]TEXT[/INST]</s>

one block per run of a role, every text closed by [/INST], so the turns can be read back.
Control strings and the escape mark inside roles and texts are escaped, reversibly:
the mark \ becomes \e, and the n-th control string becomes \n.

Defined results:
- null text or role: empty; rows with a null conv_id belong to no conversation: each is one of its own, with a null conv_id;
- null turns sort first; equal turns sort by role, then text, and repeated rows stay;
- a conversation of empty texts keeps its marks; an empty table gives no rows;
- further input columns are ignored.
One conversation is one output string, so a conversation must fit into a task; work and memory follow its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE, BODY, END = CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
MARK = "\\"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit(MARK), F.lit(MARK + "e"))
    for n, control in enumerate(CONTROLS, 1):
        out = F.replace(out, F.lit(control), F.lit(f"{MARK}{n}"))
    return out


def unescape(text: Column) -> Column:
    out = text
    for n, control in enumerate(CONTROLS, 1):
        out = F.replace(out, F.lit(f"{MARK}{n}"), F.lit(control))
    return F.replace(out, F.lit(MARK + "e"), F.lit(MARK))


def split_by(text: Column, control: str) -> Column:
    return F.split(text, F.lit(rf"\Q{control}\E"))


def merge_turns(turns: Column) -> Column:
    """array<struct<turn,role,text>> in order -> array<struct<role,texts>>, adjacent roles merged.

    A run opens where the role differs from the one before; a block is the slice up to the next opening.
    """
    last = F.size(turns)
    places = F.filter(F.sequence(F.lit(0), last), lambda i: i < last)  # an empty array has none
    opens = F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))

    def block(begin: Column, end: Column) -> Column:
        texts = F.transform(F.slice(turns, begin + 1, F.coalesce(end, last) - begin), lambda t: t["text"])
        return F.struct(F.get(turns, begin)["role"].alias("role"), texts.alias("texts"))

    return F.element_at(
        F.transform(F.array(opens), lambda o: F.zip_with(o, F.slice(o, F.lit(2), F.size(o)), block)), 1
    )


def segments_of(blocks: Column) -> Column:
    """The pieces of the formatted string, in order, each with its loss flag."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)

    def block(b: Column) -> Column:
        body = F.flatten(
            F.transform(
                b["texts"],
                lambda t: F.array(piece(escape(t), b["role"] == "assistant"), piece(F.lit(END), no)),
            )
        )
        head = piece(F.concat(F.lit(OPEN), escape(b["role"]), F.lit(BODY)), no)
        return F.concat(F.array(head), body, F.array(piece(F.lit(CLOSE), no)))

    return F.flatten(F.transform(blocks, block))


def format_chats(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> conv_id, formatted, segments (text and loss flag, in order)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.select("conv_id", turn.alias("turn"))
    named = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    alone = rows.where("conv_id IS NULL").select("conv_id", F.array("turn").alias("turns"))
    sorted_turns = named.unionByName(alone)
    pieces = sorted_turns.select("conv_id", segments_of(merge_turns(F.col("turns"))).alias("segments"))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def read_turns(formatted: Column) -> Column:
    """The formatted string back to array<struct<role,text>>, one element per original turn."""
    blocks = F.filter(split_by(formatted, CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        parts = split_by(F.substr(block, F.lit(len(OPEN) + 1)), BODY)
        named = F.struct(unescape(F.element_at(parts, 1)).alias("role"), split_by(F.element_at(parts, 2), END).alias("texts"))

        def told(b: Column) -> Column:  # role and texts are bound, so that they are split once a block
            said = F.slice(b["texts"], F.lit(1), F.size(b["texts"]) - 1)
            return F.transform(said, lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text")))

        return F.element_at(F.transform(F.array(named), told), 1)

    return F.flatten(F.transform(blocks, turns))


def op7_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = format_chats(rows).withColumn("turns", read_turns(F.col("formatted")))
    loss = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
    lines = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *,
    length(replace(replace(replace(replace(replace(text, '\', '\e'), '<s>', '\1'), '</s>', '\2'),
           '[INST]', '\3'), '[/INST]', '\4')) AS text_chars,
    length(replace(replace(replace(replace(replace(role, '\', '\e'), '<s>', '\1'), '</s>', '\2'),
           '[INST]', '\3'), '[/INST]', '\4')) AS role_chars,
    CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS role_before
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(text_chars + 7 + CASE WHEN conv_id IS NULL OR role_before IS DISTINCT FROM role THEN role_chars + 13 ELSE 0 END) AS BIGINT)
    AS formatted_chars
FROM escaped GROUP BY conv_id, alone
"""
