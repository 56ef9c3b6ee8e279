"""Chat formatting: collapse cumulative snapshots of conversations, then render what is left. DataFrame functions only.

Logs often hold a conversation several times, each time a few turns longer. A rolling hash over the turns gives every
prefix of every conversation a name; a conversation whose own name is a proper prefix of another is dropped by an
anti-join, and of equal conversations the one with the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def _turns(conversations: DataFrame) -> DataFrame:
    clean = lambda c: F.coalesce(c, F.lit(""))
    return conversations.select("conv_id", "turn", clean(F.col("role")).alias("role"), clean(F.col("text")).alias("text"))


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, number (from 1), the rolling hash of the turns up to it (one and two, sums of hashes of
    each turn and its number, together with number the prefix's name) and whether it is the last. Turns stand in the
    order of turn (null first), then role and text; null roles and texts count as empty. Sums run along the sorted turns:
    no conversation is held as a list."""
    own = F.md5(F.concat("role", F.lit("\x01"), "text").cast("binary"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "own")
    rows = _turns(conversations).select("conv_id", "turn", "role", own.alias("own"))
    rows = rows.withColumn("number", F.row_number().over(order)).withColumn("last", F.lead("own").over(order).isNull())
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    roll = lambda seed: F.sum(F.xxhash64(F.lit(seed), "number", "own").cast("decimal(20,0)")).over(so_far)
    return rows.select("conv_id", F.col("number").cast("long").alias("number"), roll(1).alias("one"), roll(2).alias("two"), "last")


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies (equal conversations, itself included) of the conversations that no longer one
    starts with."""
    name = ["number", "one", "two"]
    named = prefixes(conversations)
    inner = named.where("NOT last").select(*name).distinct()
    least = F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id"))
    whole = named.where("last").groupBy(*name).agg(least.alias("first"), F.count("*").alias("n_copies"))
    return whole.join(inner, name, "left_anti").select(F.col("first.conv_id").alias("conv_id"), F.col("number").alias("n_turns"), "n_copies")


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and text, the conversation with its role markers, for each maximal conversation.

    Markers that occur in a turn lose their bar, so a text can't forge a turn. Null and empty roles and texts are empty,
    long ones are whole. A null conv_id is one conversation; an empty table gives no rows; repeated rows, and turns that
    tie, are turns of their own, in the order of role and text. Other columns are not read.
    """
    safe = lambda c: F.replace(F.replace(c, F.lit(START), F.lit("<im_start>")), F.lit(END), F.lit("<im_end>"))
    kept = maximal(conversations)
    turns = _turns(conversations)
    rows = turns.join(kept, turns.conv_id.eqNullSafe(kept.conv_id)).drop(turns.conv_id)
    said = F.struct("turn", "role", "text")
    own = F.md5(F.concat("role", F.lit("\x01"), "text").cast("binary"))
    rows = rows.groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("turn", "role", own.alias("own"), said.alias("said")))).alias("said"))
    line = lambda t: F.concat(F.lit(START), safe(t["said"]["role"]), F.lit("\n"), safe(t["said"]["text"]), F.lit(END))
    return rows.select("conv_id", "n_turns", "n_copies", F.array_join(F.transform("said", line), "\n").alias("text"))


RENDER_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
), h AS (
  SELECT *, md5(role || chr(1) || text) AS own FROM t
), c AS (
  SELECT conv_id, count(*) AS n_turns, list(own ORDER BY turn NULLS FIRST, role, own) AS owns,
         string_agg('<|im_start|>' || replace(replace(role, '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') || chr(10)
           || replace(replace(text, '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') || '<|im_end|>',
           chr(10) ORDER BY turn NULLS FIRST, role, own) AS rendered
  FROM h GROUP BY conv_id
), n AS (
  SELECT *, array_to_string(owns, '') AS name FROM c
), p AS (
  SELECT DISTINCT array_to_string(owns[1:i], '') AS name FROM (SELECT owns, unnest(range(1, len(owns))) AS i FROM n)
), g AS (
  SELECT name, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies FROM n GROUP BY name
)
SELECT g.conv_id, g.n_turns, g.n_copies, n.rendered AS text
FROM g JOIN n ON n.conv_id IS NOT DISTINCT FROM g.conv_id
WHERE g.name NOT IN (SELECT name FROM p)
"""
