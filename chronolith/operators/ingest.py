"""Ingestion: channel payloads normalised to one envelope, transcripts cut into chunks, streams merged in time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.functions import time
from chronolith.operators.order import numbered
from chronolith.sources.readers import number, string

#: Fixed names, in merge order.
CHANNELS = ("screen", "calendar", "email", "notifications", "filesys", "audio")
#: The transcripts' header and offset lines: fixed.
HEADER = r"^##\s+(\d{2}):(\d{2}):(\d{2})\s*[–—\-]\s*(\d{2}):(\d{2}):(\d{2})\s*$"
OFFSET = r"^\[(\d{2}):(\d{2})(?::(\d{3}))?\]\s*(.*)$"


def _entries(source: Column) -> Column:
    return F.try_variant_get(source, "$", "map<string,variant>")


def normalised(rows: DataFrame, channel: str) -> DataFrame:
    """rows (us, text, source as variant) of a channel as envelopes: us, ts_iso, channel, text, source (map of variants)."""
    fields = _entries(F.col("source"))
    text = lambda c: F.to_variant_object(F.struct(c.alias("v")))
    wrap = lambda c: F.try_variant_get(text(c), "$.v", "variant")
    if channel == "screen":
        keep = F.map_filter(fields, lambda k, _: ~k.isin("start_time", "raw_events", "screenshot_path"))
        path = string(F.col("source"), "$.screenshot_path")
        start = F.try_variant_get("source", "$.start_time", "variant")
        more = F.map_from_arrays(F.array(F.lit("start_time_local"), F.lit("screenshot_path")), F.array(start, F.when(F.length(path) > 0, wrap(F.concat(F.lit("screenshots/"), words.base_name(path)))).otherwise(F.try_variant_get("source", "$.screenshot_path", "variant"))))
        fields = F.map_concat(keep, F.map_filter(more, lambda _, v: v.isNotNull()))
    elif channel == "email":
        date = time.parse_mail_date(string(F.col("source"), "$.date"))
        more = F.map_from_arrays(F.array(F.lit("date_utc_iso")), F.array(wrap(date)))
        fields = F.when(date.isNotNull(), F.map_concat(F.map_filter(fields, lambda k, _: k != "date_utc_iso"), more)).otherwise(fields)
    elif channel == "notifications":
        stamp = number(F.col("source"), "$.timestamp")
        # A whole number stays one.
        whole = F.schema_of_variant(F.try_variant_get("source", "$.timestamp", "variant")) == "BIGINT"
        shifted = F.when(whole, wrap(F.try_variant_get("source", "$.timestamp", "bigint") + time.EPOCH_2001)).otherwise(wrap(stamp + time.EPOCH_2001))
        more = F.map_from_arrays(F.array(F.lit("timestamp")), F.array(shifted))
        fields = F.when(stamp.isNotNull(), F.map_concat(F.map_filter(fields, lambda k, _: k != "timestamp"), more)).otherwise(fields)
    return rows.select("us", time.iso_millis(F.col("us")).alias("ts_iso"), F.lit(channel).alias("channel"), F.coalesce("text", F.lit("")).alias("text"), fields.alias("source"))


def image_path(channel: Column, path: Column) -> Column:
    """Paths of screen rows become screenshots/<name>; others stay."""
    return F.when((channel == "screen") & (F.length(path) > 0), F.concat(F.lit("screenshots/"), words.base_name(path))).otherwise(path)


def since(rows: DataFrame, cutover_us: int = time.CUTOVER_US) -> DataFrame:
    return rows.where(F.col("us") >= cutover_us)


def _merge_order() -> Column:
    return F.coalesce(F.nullif(F.array_position(F.lit(list(CHANNELS)), F.col("channel")), F.lit(0)), F.lit(len(CHANNELS) + 1))


def merged(*streams: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """All streams in the order of time; at equal instants in the order of CHANNELS."""
    return reduce(DataFrame.unionByName, streams).orderBy("us", _merge_order(), *ties)


def merged_positions(*streams: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """The rows of merged() with their position from 1."""
    return numbered(reduce(DataFrame.unionByName, streams), "position", "us", _merge_order(), *ties)


def chunks(lines: DataFrame, zone: str = time.LOCAL_ZONE) -> DataFrame:
    """Chunks of transcript lines (name, line_no, value): us, ts_iso, channel, text (the first 200 characters), and source:
    file, chunk_start_local, chunk_end_local, duration_s, transcript, lines (offset_s and text).

    A line belongs to the last header before it; lines before the first go. A start below the one before it is on the
    next day, an end below its start too. Durations are wall-clock differences.
    """
    by_file = Window.partitionBy("name").orderBy("line_no")
    seconds = lambda a: F.regexp_extract("value", HEADER, a).cast("int") * 3600 + F.regexp_extract("value", HEADER, a + 1).cast("int") * 60 + F.regexp_extract("value", HEADER, a + 2).cast("int")
    is_header = F.col("value").rlike(HEADER)
    rows = lines.withColumn("header", is_header).withColumn("chunk", F.sum(is_header.cast("int")).over(by_file)).where("chunk > 0")
    heads = rows.where("header").select("name", "chunk", seconds(1).alias("start_s"), seconds(4).alias("end_s"))
    by_chunk = Window.partitionBy("name").orderBy("chunk")
    wrapped = (F.col("start_s") < F.lag("start_s").over(by_chunk)).cast("int")
    heads = heads.withColumn("wrapped", F.coalesce(wrapped, F.lit(0))).withColumn("days", F.sum("wrapped").over(by_chunk))
    clock = lambda c: F.date_format(F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c.cast("decimal(18,6)")), "HH:mm:ss")
    date = F.date_add(F.to_date(F.substring("name", 1, 10)), F.col("days").cast("int"))
    local = date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("start_s").cast("decimal(18,6)"))
    us = time.micros(F.convert_timezone(F.lit(zone), F.lit("UTC"), local))
    duration = F.when(F.col("end_s") < F.col("start_s"), F.col("end_s") + 86_400).otherwise(F.col("end_s")) - F.col("start_s")
    heads = heads.select("name", "chunk", us.alias("us"), clock(F.col("start_s")).alias("chunk_start_local"), clock(F.col("end_s")).alias("chunk_end_local"), duration.cast("double").alias("duration_s"))
    part = lambda i: F.regexp_extract("value", OFFSET, i)
    timed = F.col("value").rlike(OFFSET)
    offset = part(1).cast("int") * 60 + part(2).cast("int") + F.coalesce(F.nullif(part(3), F.lit("")).cast("int"), F.lit(0)) / 1000
    body = rows.where("NOT header").where(F.trim("value") != "").select("name", "chunk", "line_no", F.when(timed, offset).cast("double").alias("offset_s"), F.when(timed, part(4)).otherwise(F.col("value")).alias("text"))
    said = body.groupBy("name", "chunk").agg(F.sort_array(F.collect_list(F.struct("line_no", "offset_s", "text"))).alias("said"))
    out = heads.join(said, ["name", "chunk"], "left").withColumn("said", F.coalesce("said", F.expr("cast(array() as array<struct<line_no:int,offset_s:double,text:string>>)")))
    transcript = F.array_join(F.transform("said", lambda r: r["text"]), " ")
    timed_lines = F.transform(F.filter("said", lambda r: r["offset_s"].isNotNull()), lambda r: F.struct(r["offset_s"].alias("offset_s"), r["text"].alias("text")))
    source = F.struct(F.col("name").alias("file"), "chunk_start_local", "chunk_end_local", "duration_s", transcript.alias("transcript"), timed_lines.alias("lines"))
    return out.select("us", time.iso_millis(F.col("us")).alias("ts_iso"), F.lit("audio").alias("channel"), F.substring(transcript, 1, 200).alias("text"), source.alias("source"))
