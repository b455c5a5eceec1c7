"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and all others as
named users; mask spans cover what the assistant says, with its end mark. A rendering is stored as consecutive parts of at
most `limit` turns, so that no row grows without bound: each has the number of characters before it (first_char), spans count
from the start of the dialogue, and the parts of a participant put together in the order of `part` are the whole rendering,
whatever the limit. Positions within a conversation are distributed prefix sums over a range partitioning, so a conversation
with a third of all rows is spread over many tasks.

Nulls: a null role speaks as "unknown" (and is one with a role of that name), a null text is empty, a null turn comes first,
and rows without conv_id form one conversation. Ties of turn are put in the order of role and text. Control marks inside
texts and names are broken up, so names that differ in nothing but "<|" for "< |" are one speaker. A repeated row is a turn
of its own. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored

TURNS = 512
END = "<|end|>\n"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def positions(turns: DataFrame) -> DataFrame:
    """conv_id, speaker, body, at (from 0 within the conversation)."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "speaker", "body"]
    clean = turns.select("conv_id", "turn", _plain(F.coalesce("role", F.lit("unknown"))).alias("speaker"), _plain(F.coalesce("text", F.lit(""))).alias("body"))
    dealt = clean.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(dealt.select("conv_id", "speaker", "body", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")), "turns")
    runs = rows.groupBy("conv_id", "p").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(F.col("conv_id").alias("c"), F.col("p").alias("q"), "first", before.alias("before"))
    on = rows["conv_id"].eqNullSafe(starts["c"]) & (rows["p"] == starts["q"])
    return rows.join(starts, on).select("conv_id", "speaker", "body", (F.col("i") - F.col("first") + F.col("before")).alias("at"))


def _heads(speaker: Column, own: Column) -> Column:
    return F.when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user:"), speaker, F.lit("|>\n")))


def part_starts(rows: DataFrame) -> DataFrame:
    """c, p, participant, first_char: the characters before each part, in every participant's rendering.

    Summed from a row for each part and speaker; only these are dealt by participant.
    """
    as_user = F.length(_heads(F.col("speaker"), F.lit(False))) + F.length("body") + len(END)
    said = rows.groupBy("conv_id", "part", "speaker").agg(F.sum(as_user).alias("chars"), F.sum(F.length(_heads(F.col("speaker"), F.lit(True))) - F.length(_heads(F.col("speaker"), F.lit(False)))).alias("own"))
    parts = said.groupBy("conv_id", "part").agg(F.sum("chars").alias("chars"), F.map_from_entries(F.collect_list(F.struct("speaker", "own"))).alias("own"))
    cast = said.select(F.col("conv_id").alias("c"), F.col("speaker").alias("participant")).distinct()
    each = parts.join(cast, F.col("conv_id").eqNullSafe(F.col("c")))
    size = F.col("chars") + F.coalesce(F.try_element_at("own", F.col("participant")), F.lit(0))
    before = F.sum(size).over(Window.partitionBy("c", "participant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return each.select("c", F.col("part").alias("p"), "participant", F.coalesce(before, F.lit(0)).alias("first_char"))


def rotations(turns: DataFrame, limit: int = TURNS) -> DataFrame:
    """conv_id, participant, part, first_char, n_turns, rendered, mask_spans ("start:end,..." in characters of the dialogue),
    n_masked."""
    at = stored(positions(turns), "positions")
    rows = at.withColumn("part", F.floor(F.col("at") / limit).cast("int"))
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("at", "speaker", "body"))).alias("said"))
    starts = part_starts(rows)
    each = parts.join(starts, parts["conv_id"].eqNullSafe(starts["c"]) & (parts["part"] == starts["p"])).drop("c", "p")
    me = lambda x: x["speaker"] == F.col("participant")
    head = lambda x: _heads(x["speaker"], me(x))
    text = F.array_join(F.transform("said", lambda x: F.concat(head(x), x["body"], F.lit(END))), "")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(head(x))
        end = start + F.length(x["body"]) + len(END)
        spans = F.when(me(x), F.concat(acc["spans"], F.array(F.concat_ws(":", start.cast("string"), end.cast("string"))))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"), F.when(me(x), acc["n"] + end - start).otherwise(acc["n"]).alias("n"))

    zero = F.struct(F.col("first_char").alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("bigint").alias("n"))
    masks = F.aggregate("said", zero, step)
    full = each.select("conv_id", "participant", "part", "first_char", F.size("said").cast("bigint").alias("n_turns"), text.alias("rendered"), masks.alias("m"))
    return full.select("conv_id", "participant", "part", "first_char", "n_turns", "rendered", F.array_join("m.spans", ",").alias("mask_spans"), F.col("m.n").alias("n_masked"))


ORACLE = """
WITH t AS (SELECT conv_id, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body, turn FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) - 1 AS pos FROM t),
c AS (SELECT DISTINCT conv_id, speaker AS participant FROM p),
s AS (SELECT p.conv_id, participant, floor(pos / 512.0)::INTEGER AS part, pos, speaker = participant AS me, body,
  CASE WHEN speaker = participant THEN '<|assistant|>' || chr(10) ELSE '<|user:' || speaker || '|>' || chr(10) END AS head
  FROM p JOIN c ON p.conv_id IS NOT DISTINCT FROM c.conv_id),
l AS (SELECT *, sum(length(head) + length(body) + 8) OVER (PARTITION BY conv_id, participant ORDER BY pos) AS e FROM s)
SELECT conv_id, participant, part, min(e - length(head) - length(body) - 8)::BIGINT AS first_char, count(*) AS n_turns,
  string_agg(head || body || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered,
  coalesce(string_agg((e - length(body) - 8)::BIGINT::VARCHAR || ':' || e::BIGINT::VARCHAR, ',' ORDER BY pos) FILTER (WHERE me), '') AS mask_spans,
  coalesce(sum(length(body) + 8) FILTER (WHERE me), 0)::BIGINT AS n_masked
FROM l GROUP BY conv_id, participant, part
"""
