"""Activity intervals: tumbling buckets anchored at the first event, their counts by channel, and days of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.functions import time

QUARTER_US = 15 * 60 * 1_000_000


def bounds(events: DataFrame, width_us: int) -> DataFrame:
    """One row: the first and last instant, and the number of buckets (1 at least)."""
    span = F.col("hi") - F.col("lo")
    return events.agg(F.min("us").alias("lo"), F.max("us").alias("hi")).withColumn("buckets", F.greatest(F.lit(1), F.ceil(span / width_us)).cast("long"))


def bucketed(events: DataFrame, width_us: int = QUARTER_US) -> DataFrame:
    """events (us, channel) with bucket: half-open ranges, the last one closed and cut at the last event."""
    one = F.broadcast(bounds(events, width_us))  # a single row
    rows = events.where("us IS NOT NULL").crossJoin(one)
    return rows.withColumn("bucket", F.least(F.expr(f"(us - lo) div {width_us}"), F.col("buckets") - 1))


def channel_counts(events: DataFrame, width_us: int = QUARTER_US) -> DataFrame:
    """bucket, channel, event_count."""
    return bucketed(events, width_us).groupBy("bucket", "channel").agg(F.count("*").alias("event_count"))


def activity(events: DataFrame, width_us: int = QUARTER_US, include_empty: bool = False, zone: str = time.LOCAL_ZONE) -> DataFrame:
    """One row an interval: interval_index (dense), start and end (us, UTC and local text), duration_seconds, event_count and
    channel_counts, a map. Empty intervals only with include_empty."""
    rows = bucketed(events, width_us)
    counts = rows.groupBy("bucket", "channel").agg(F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    entries = F.array_sort(F.collect_list(F.struct("channel", "n")))
    per = counts.groupBy("bucket").agg(F.sum("n").alias("event_count"), F.map_from_entries(entries).alias("channel_counts"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    if include_empty:
        every = bounds(events, width_us).where("lo IS NOT NULL").select("lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"))
        per = every.join(per.drop("lo", "hi"), "bucket", "left").withColumn("event_count", F.coalesce("event_count", F.lit(0)))
        per = per.withColumn("channel_counts", F.coalesce("channel_counts", F.expr("cast(map() as map<string,bigint>)"))).withColumn("interval_index", F.col("bucket"))
    else:
        per = per.withColumn("interval_index", (F.dense_rank().over(Window.orderBy("bucket")) - 1).cast("long"))  # one row an interval
    start = F.col("lo") + F.col("bucket") * width_us
    per = per.withColumn("start_us", start).withColumn("end_us", F.least(start + width_us, F.col("hi")))
    return per.select(
        "interval_index",
        "start_us",
        "end_us",
        time.iso_millis(F.col("start_us")).alias("start_utc"),
        time.iso_millis(F.col("end_us")).alias("end_utc"),
        time.iso_local(F.col("start_us"), zone).alias("start_local"),
        time.iso_local(F.col("end_us"), zone).alias("end_local"),
        ((F.col("end_us") - F.col("start_us")) / 1_000_000).alias("duration_seconds"),
        F.col("event_count").cast("long").alias("event_count"),
        "channel_counts",
    )


def by_day(intervals: DataFrame) -> DataFrame:
    """day_index (in order of first appearance), day, intervals, first_index, last_index and label of each day."""
    day = time.day_key(F.col("start_local"), F.col("start_utc"), F.col("start_us"))
    days = intervals.groupBy(day.alias("day")).agg(F.count("*").alias("intervals"), F.min("interval_index").alias("first_index"), F.max("interval_index").alias("last_index"))
    from chronolith.functions.text import range_label

    index = (F.row_number().over(Window.orderBy("first_index")) - 1).cast("long")  # one row a day
    return days.select(index.alias("day_index"), "day", "intervals", "first_index", "last_index", range_label(F.col("first_index"), F.col("last_index")).alias("label"))


def parse_range(raw: str | None) -> tuple[int, int] | None:
    """START-END, both included; nothing else."""
    if not raw:
        return None
    first, dash, last = raw.partition("-")
    if "," in raw or not dash or not first.strip().isdigit() or not last.strip().isdigit():
        raise ValueError(f"not one range START-END of indexes: {raw}")
    if int(last) < int(first):
        raise ValueError(f"the range ends before it starts: {raw}")
    return int(first), int(last)


def parse_list(raw: str | None) -> list[tuple[int, int]] | None:
    """Ranges of a list such as 0,3,10-12."""
    if not raw:
        return None
    out = []
    for part in filter(None, (p.strip() for p in raw.split(","))):
        out.append(parse_range(part) if "-" in part else (int(part), int(part)))
    return out


def in_ranges(column: str, ranges: list[tuple[int, int]] | None):
    """A condition that the column lies in one of the ranges; with none all rows pass."""
    if ranges is None:
        return F.lit(True)
    found = F.lit(False)
    for a, b in ranges:
        found = found | F.col(column).between(a, b)
    return found


def selected(rows: DataFrame, range_text: str | None = None, start: int = 0, limit: int | None = None, order: str = "interval_index") -> DataFrame:
    """Range, then offset, then limit, in this order."""
    parsed = parse_range(range_text)
    rows = rows.where(in_ranges(order, None if parsed is None else [parsed])).orderBy(order).offset(start)
    return rows if limit is None else rows.limit(limit)


def duplicate_indexes(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return rows.groupBy(*(keys or ("interval_index",))).agg(F.count("*").alias("n")).where("n > 1")


def cutoff(end_us: Column, end_utc: Column, end_local: Column) -> Column:
    """The instant at which an interval ends: the number, else the first text that is given, UTC before local."""
    return F.coalesce(end_us, time.parse_event(F.lit(None).cast("double"), words.first_text(end_utc, end_local)))
