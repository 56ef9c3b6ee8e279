"""As-of joins by position: the last events before an anchor, and the neighbourhood on both sides of it.

A range join compares every anchor with every event before it. Here events get their position in time, anchors the
number of events up to them, and each anchor asks for the few blocks of positions that it needs: an equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.operators.order import bounds, counts_until, positions

CONTEXT = 100
AROUND = 200


def _slices(events: DataFrame, wanted: DataFrame, key: str, ties: tuple[str, ...], ends: list[int], block: int) -> DataFrame:
    """wanted (first and last position, other columns) with _events, the events between them, in one or more rows each.

    Events are gathered into blocks of neighbouring positions, so an anchor meets a few blocks instead of each event."""
    placed = positions(events, "us", list(ties), ends=ends)
    columns = [c for c in placed.columns if c != "pos"]
    gathered = placed.groupBy(F.expr(f"pos div {block}").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("_events"))  # block events at most
    spread = wanted.withColumn("_block", F.explode(F.sequence(F.expr(f"first div {block}"), F.expr(f"last div {block}"))))
    start = F.greatest(F.col("first") - F.col("_block") * block, F.lit(0))
    stop = F.least(F.col("last") - F.col("_block") * block, F.lit(block - 1))
    part = F.slice("_events", (start + 1).cast("int"), (stop - start + 1).cast("int"))
    return spread.join(gathered, "_block").withColumn("_events", part).drop("_block")


def _wanted(events: DataFrame, anchors: DataFrame, limit: int, key: str, ends: list[int]) -> DataFrame:
    if limit <= 0:
        raise ValueError("the limit must be positive")
    counted = counts_until(events, anchors, "us", key, ends).where("n_le > 0").withColumnRenamed("us", "anchor_us")
    return counted.select(key, "anchor_us", F.greatest(F.lit(0).cast("long"), F.col("n_le") - limit).alias("first"), (F.col("n_le") - 1).alias("last"))


def context_rows(events: DataFrame, anchors: DataFrame, limit: int = CONTEXT, key: str = "anchor_id", ties: tuple[str, ...] = ("seq",)) -> DataFrame:
    """For each anchor (key, us) its latest events with us at or before it, at most limit: key, anchor_us, index (from 0,
    ascending in time) and the events' columns. Anchors before every event give no rows."""
    ends = bounds(events, "us")
    rows = _slices(events, _wanted(events, anchors, limit, key, ends), key, ties, ends, limit)
    rows = rows.select(key, "anchor_us", "first", F.explode("_events").alias("_e"))
    names = [c for c in events.columns if c not in (key, "anchor_us")]
    return rows.select(key, "anchor_us", *(F.col(f"_e.{c}") for c in names), (F.col("_e.pos") - F.col("first")).alias("index"))


def contexts(events: DataFrame, anchors: DataFrame, limit: int = CONTEXT, key: str = "anchor_id", ties: tuple[str, ...] = ("seq",)) -> DataFrame:
    """anchors with context: an array of (index, us, channel, text), empty where no event precedes."""
    ends = bounds(events, "us")
    slim = events.select(*dict.fromkeys(("us", "channel", "text", *ties)))
    rows = _slices(slim, _wanted(events, anchors, limit, key, ends), key, ties, ends, limit)
    item = lambda e: F.struct((e["pos"] - F.col("first")).alias("index"), e["us"].alias("us"), e["channel"].alias("channel"), e["text"].alias("text"))
    rows = rows.select(key, F.transform("_events", item).alias("_part"))
    made = rows.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("_part"))).alias("context"))  # limit items at most
    empty = F.expr("cast(array() as array<struct<index:bigint,us:bigint,channel:string,text:string>>)")
    return anchors.join(made, key, "left").withColumn("context", F.coalesce("context", empty))


def around(events: DataFrame, anchors: DataFrame, before: int = AROUND, after: int = AROUND, key: str = "anchor_id", ties: tuple[str, ...] = ("seq",)) -> DataFrame:
    """For each anchor the last events up to it and the first after it: key, side (past or future), index, the events'
    columns, and before_available and after_available, how many there are in all."""
    if before < 0 or after < 0:
        raise ValueError("before and after must not be negative")
    ends = bounds(events, "us")
    counted = counts_until(events, anchors, "us", key, ends).drop("us")
    total = F.broadcast(events.where("us IS NOT NULL").agg(F.count("*").alias("total")))  # a single row
    counted = counted.crossJoin(total)
    wanted = counted.select(
        key,
        F.col("n_le").alias("before_available"),
        (F.col("total") - F.col("n_le")).alias("after_available"),
        F.greatest(F.lit(0).cast("long"), F.col("n_le") - before).alias("first"),
        (F.least(F.col("n_le") + after, F.col("total")) - 1).alias("last"),
    )
    rows = _slices(events, wanted.where("first <= last"), key, ties, ends, max(1, before + after))
    rows = rows.select(key, "before_available", "after_available", "first", F.explode("_events").alias("_e"))
    is_past = F.col("_e.pos") < F.col("before_available")
    index = F.when(is_past, F.col("_e.pos") - F.col("first")).otherwise(F.col("_e.pos") - F.col("before_available"))
    names = [c for c in events.columns if c not in (key, "before_available", "after_available")]
    return rows.select(key, "before_available", "after_available", *(F.col(f"_e.{c}") for c in names), F.when(is_past, "past").otherwise("future").alias("side"), index.alias("index"))
