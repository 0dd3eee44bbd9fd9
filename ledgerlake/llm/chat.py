"""Operator 4: multi-party perspective rotation of dialogues.

For every participant a dialogue is rendered with that speaker as the
assistant and all others as named users; the mask lists the code points that
count for the loss: the assistant's texts with their end marks.  System turns
belong to nobody and are rendered as such in every perspective.

A dialogue is rendered in parts of ``PART_TURNS`` turn numbers, so no group
grows with the dialogue; one of fewer turns is a single part.  Spans count
from the start of the part.

Defined results: exact repeats of a turn count once; turns with equal numbers
follow each other by role and text; a null text is empty, a null role is
``unknown``, a null turn comes first (part -1); null conv_ids form one
dialogue; extra columns are ignored; a dialogue of system turns alone gives no
row; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import table

PART_TURNS = 128
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>\n"


def _head(role: Column, participant: Column) -> Column:
    return F.concat(F.lit(START), F.when(role == SYSTEM, F.lit(SYSTEM)).when(role == participant, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), role)), F.lit("\n"))


def rotate(turns: DataFrame) -> DataFrame:
    """conv_id, participant, part, n_turns, text, mask (array of start, end; end exclusive)."""
    clean = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-1)).cast("long").alias("part")).distinct()
    parts = clean.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))   # PART_TURNS turn numbers
    speakers = (clean.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role")
                                                            .alias("participant")).distinct())
    each = parts.join(speakers, parts["conv_id"].eqNullSafe(speakers["c"])).drop("c")
    me = F.col("participant")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(_head(t["role"], me))
        end = start + F.char_length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        own = (t["role"] == me) & (t["role"] != SYSTEM)
        return F.struct(end.alias("at"), F.when(own, F.concat(acc["mask"], span)).otherwise(acc["mask"]).alias("mask"))

    return each.select(
        "conv_id", "participant", "part", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(_head(t["role"], me), t["text"], F.lit(END))), "")
        .alias("text"),
        F.aggregate("turns", zero, step, lambda acc: acc["mask"]).alias("mask"))


def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rotate(table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", "participant", "part", "n_turns", "text", F.array_join(F.transform(
        "mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("mask"))


ORACLE_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                  coalesce(CAST(floor(turn / 128.0) AS BIGINT), -1) AS part FROM conversations),
who AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
said AS (SELECT t.*, participant, '<|im_start|>' || CASE WHEN role = 'system' THEN 'system'
                WHEN role = participant THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head
         FROM t JOIN who ON t.conv_id IS NOT DISTINCT FROM who.conv_id),
placed AS (SELECT *, sum(length(head) + length(text) + 11) OVER (
               PARTITION BY conv_id, participant, part ORDER BY turn NULLS FIRST, role, text) AS till FROM said)
SELECT conv_id, participant, part, count(*) AS n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg((till - length(text) - 11)::BIGINT || ':' || till::BIGINT, ','
                           ORDER BY turn NULLS FIRST, role, text)
                FILTER (WHERE role = participant), '') AS mask
FROM placed GROUP BY conv_id, participant, part
"""
