"""Readers of JSON lines, JSON documents and transcripts, with physical line numbers where order needs them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.functions import time
from chronolith.sources.sinks import stored

#: What ends a line beside line feeds and carriage returns: fixed.
LINE = "[\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def raw_lines(spark: SparkSession, path: str, pattern: str, recursive: bool = False) -> DataFrame:
    """path, name, line_no (from 1) and value of every line. A large file is read in splits: lines are numbered within a
    split as they are read, and the counts of a file's earlier splits are added, so no file needs to fit in a task and no
    line is shuffled or sorted. The files are read once, by this call: the lines are stored with their ids."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive)
    meta = ("file_path", "file_name", "file_block_start")
    rows = reader.text(path).select(*(F.col(f"_metadata.{m}").alias(m) for m in meta), F.explode(F.split("value", LINE)).alias("value"))
    # Within a task ids follow the order of reading, and a split is read by one task.
    rows = stored(rows.withColumn("id", F.monotonically_increasing_id()), "lines")
    sizes = rows.groupBy("file_path", "file_block_start").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    sizes = sizes.select("file_path", "file_block_start", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    rows = rows.join(F.broadcast(sizes), ["file_path", "file_block_start"])
    return rows.select(F.col("file_path").alias("path"), F.col("file_name").alias("name"), (F.col("base") + F.col("id") + 1).cast("long").alias("line_no"), "value")


def lines(spark: SparkSession, path: str, pattern: str = "*.jsonl", recursive: bool = False) -> DataFrame:
    """path, line_no (from 1) and value of every line that isn't blank."""
    rows = raw_lines(spark, path, pattern, recursive)
    return rows.where(F.trim("value") != "").select("path", "line_no", F.trim("value").alias("value"))


def parsed(value: Column, where: Column) -> Column:
    """JSON as a variant; what is malformed is an error that names the place."""
    doc = F.try_parse_json(value)
    return F.when(doc.isNull(), F.raise_error(F.concat(F.lit("malformed JSON in "), where)).cast("variant")).otherwise(doc)


def unnumbered_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl", recursive: bool = False) -> DataFrame:
    """path and value of every line that isn't blank, line_no null: the files are read once, as nothing is counted first."""
    rows = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.lit(None).cast("long").alias("line_no"), F.explode(F.split("value", LINE)).alias("value"))
    return rows.where(F.trim("value") != "").select("path", "line_no", F.trim("value").alias("value"))


def json_lines(spark: SparkSession, path: str, fail: bool = True, numbered: bool = True, **options) -> DataFrame:
    """Lines as variants; a malformed one is an error, or with fail=False its row is kept with doc null."""
    where = F.concat(F.col("path"), F.lit(", line "), F.coalesce(F.col("line_no").cast("string"), F.lit("unknown")))
    return (lines if numbered else unnumbered_lines)(spark, path, **options).withColumn("doc", parsed(F.col("value"), where) if fail else F.try_parse_json("value"))


def is_object(doc: Column) -> Column:
    return F.schema_of_variant(doc).startswith("OBJECT")


def number(doc: Column, path: str) -> Column:
    """A JSON number as a double; a text of digits is no number."""
    value = F.try_variant_get(doc, path, "variant")
    return F.when(F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT)"), F.try_variant_get(doc, path, "double"))


def string(doc: Column, path: str) -> Column:
    value = F.try_variant_get(doc, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(doc, path, "string"))


def channel_logs(spark: SparkSession, path: str, cutover_us: int = time.CUTOVER_US, **options) -> DataFrame:
    """Raw channel logs: us, text and source of each line whose timestamp is a number not before the cut-over."""
    rows = json_lines(spark, path, **options)
    us = time.seconds_to_micros(number(F.col("doc"), "$.timestamp"))
    rows = rows.select("path", "line_no", us.alias("us"), F.coalesce(string(F.col("doc"), "$.text"), F.lit("")).alias("text"), F.try_variant_get("doc", "$.source", "variant").alias("source"))
    return rows.where(F.col("us") >= cutover_us)


def rows_with_index(spark: SparkSession, path: str, **options) -> DataFrame:
    """Objects with interval_index, the line's number where they have none. Anything but an object is an error."""
    rows = json_lines(spark, path, **options)
    rows = rows.where(F.when(is_object(F.col("doc")), F.lit(True)).otherwise(F.raise_error("expected one object a line").cast("boolean")))
    return rows.withColumn("interval_index", F.coalesce(F.try_variant_get("doc", "$.interval_index", "bigint"), F.col("line_no")))


#: Why lines are left out of a log.
REASONS = ("malformed", "not an object", "no instant")


def judged(rows: DataFrame, recursive: bool, text_stamps: bool = True) -> DataFrame:
    """rows (doc) with us and reason: why the line is no event, null if it is one."""
    stamp = string(F.col("doc"), "$.ts_iso" if recursive else "$.ts")
    us = time.parse_event(number(F.col("doc"), "$.ts"), stamp) if recursive else time.parse_window_end(number(F.col("doc"), "$.ts"), stamp if text_stamps else F.lit(None).cast("string"))
    rows = rows.withColumn("us", F.when(F.col("doc").isNotNull() & is_object(F.col("doc")), us))
    return rows.withColumn("reason", F.when(F.col("doc").isNull(), REASONS[0]).when(~is_object(F.col("doc")), REASONS[1]).when(F.col("us").isNull(), REASONS[2]))


def counts_of(reason: Column) -> list[Column]:
    """How many lines there are, and by reason how many are left out, as metrics that a pass over the rows can observe."""
    return [F.count(F.lit(1)).alias("lines"), *(F.count_if(F.coalesce(reason == r, F.lit(False))).alias(r) for r in REASONS)]


def event_log(spark: SparkSession, path: str, recursive: bool = False, text_stamps: bool = True, pattern: str = "*.jsonl", numbered: bool = True, observed: Observation | None = None) -> DataFrame:
    """The sharded event log: us, ts_iso, channel, text, path, line_no and seq-free total order (us, path, line_no).

    Two levels deep, or at any depth with recursive. Hidden folders, malformed lines, other values than objects and rows
    without an instant are skipped; observed holds counts_of them as soon as the rows have been read, from the same pass.
    channel falls back to the folder's name, text to a text of the payload. Without numbers files are read once.
    """
    where = path if recursive else f"{path}/*/{pattern}"
    rows = json_lines(spark, where, fail=False, numbered=numbered, recursive=recursive, pattern=pattern).where(~F.col("path").rlike(r"/\.[^/]+/"))
    rows = judged(rows, recursive, text_stamps)
    if observed is not None:
        rows = rows.observe(observed, *counts_of(F.col("reason")))
    rows = rows.where("reason IS NULL")
    folder = F.element_at(F.split("path", "/"), -2)
    fallback = F.coalesce(words.json_text(F.try_variant_get("doc", "$.source", "variant"), "summary", "dense_caption", "title", "subject"), F.lit(""))
    rows = rows.select("path", "line_no", "us", words.first_text(string(F.col("doc"), "$.channel"), string(F.col("doc"), "$.connector"), default=folder).alias("channel"), words.first_text(string(F.col("doc"), "$.text"), default=fallback).alias("text"), string(F.col("doc"), "$.ts_iso").alias("ts_iso"))
    return rows.withColumn("ts_iso", words.first_text(F.col("ts_iso"), default=time.iso_short(F.col("us"))))


def skipped(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """path, line_no and reason of the lines that event_log(recursive=True) skips."""
    rows = judged(json_lines(spark, path, fail=False, recursive=True, pattern=pattern), recursive=True)
    return rows.select("path", "line_no", "reason").where("reason IS NOT NULL")


def documents(spark: SparkSession, path: str, pattern: str = "*.json", kind: str | None = None) -> DataFrame:
    """path, name and doc of whole-file JSON; malformed files, and with kind (ARRAY or OBJECT) any other value, are errors."""
    rows = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), "value")
    rows = rows.select("path", "name", parsed(F.col("value"), F.col("path")).alias("doc"))
    if kind:
        rows = rows.where(F.when(F.schema_of_variant("doc").startswith(kind), F.lit(True)).otherwise(F.raise_error(f"expected {kind}").cast("boolean")))
    return rows


def items(rows: DataFrame) -> DataFrame:
    """An array gives a row for each member, in order; anything else one row: path, position and doc."""
    as_list = F.when(F.schema_of_variant("doc").startswith("ARRAY"), F.try_variant_get("doc", "$", "array<variant>")).otherwise(F.array("doc"))
    return rows.select("path", F.posexplode(as_list).alias("position", "doc"))


def named(rows: DataFrame, pattern: str, *names: str) -> DataFrame:
    """rows whose file name matches, with the pattern's groups as numbers under names."""
    out = rows.where(F.col("name").rlike(f"^{pattern}$"))
    for i, n in enumerate(names, 1):
        out = out.withColumn(n, F.regexp_extract("name", f"^{pattern}$", i).try_cast("long"))
    return out


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """name, line_no (from 0) and value of every line of transcript files with a date in their name."""
    rows = raw_lines(spark, path, "*.md").where(F.col("name").rlike(r"^\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}\.md$"))
    return rows.select("name", (F.col("line_no") - 1).alias("line_no"), "value")


def dated(rows: DataFrame, stamp: Column, name: str = "us") -> DataFrame:
    """rows whose missing instants are filled in from a text that holds one."""
    own = F.col(name) if name in rows.columns else F.lit(None).cast("long")
    return rows.withColumn(name, F.coalesce(own, time.parse_first(stamp)))
