"""The read queries over artifact tables: runs, scopes, manifest, themes, opportunities, documents, neighbourhoods."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.operators import asof, pairs
from chronolith.operators import zones as near
from chronolith.operators.order import numbered

#: What the read queries take for a scope, a type and a seed: fixed.
SCOPE = re.compile(r"^(?:global|(?:days|intervals)_[A-Za-z0-9_\-]+)$")
TYPE = re.compile(r"^[a-z][a-z0-9_]*$")
SEED = re.compile(r"^[A-Za-z0-9_]+$")


def checked(pattern: re.Pattern, value: str) -> str:
    if not pattern.fullmatch(value or ""):
        raise ValueError(f"not valid: {value!r}")
    return value


def runs(artifacts: DataFrame) -> DataFrame:
    """artifacts (run, stage, modified): run, a count and a flag for each stage, those with most themes first, then latest."""
    stages = ("themes", "combined", "opportunities", "questions", "interval_qa", "seed_qa")
    count = lambda s: F.count_if(F.col("stage") == s)
    flags = [F.bool_or(F.col("stage") == s).alias(f"has_{s}") for s in stages]
    rows = artifacts.groupBy("run").agg(count("themes").alias("theme_count"), F.max(F.when(F.col("stage") == "themes", F.col("modified"))).alias("latest"), *flags)
    return rows.orderBy(F.desc("theme_count"), F.desc_nulls_last("latest"), F.desc("run"))


def latest_run(artifacts: DataFrame) -> DataFrame:
    return artifacts.agg(F.max("run").alias("run"))


def scopes(artifacts: DataFrame) -> DataFrame:
    """scope and position: global first, the others in natural order; global alone if there is none."""
    rows = artifacts.select("scope").distinct()
    return numbered(rows, "position", F.when(F.col("scope") == "global", 0).otherwise(1), words.natural_key(F.col("scope")), "scope")


def theme_list(themes: DataFrame, interval: int | None = None) -> DataFrame:
    """themes (interval_index, items) one a row: id (interval-rank), interval_index, rank and the theme's fields."""
    rows = themes if interval is None else themes.where(F.col("interval_index") == interval)
    rows = rows.select("interval_index", F.posexplode("items").alias("rank", "item")).where("item IS NOT NULL")
    rank = (F.col("rank") + 1).cast("long")
    return rows.select(F.concat_ws("-", F.col("interval_index").cast("string"), rank.cast("string")).alias("id"), "interval_index", rank.alias("rank"), "item.*")


def manifest(combined: DataFrame, opportunities: DataFrame, questions: DataFrame) -> DataFrame:
    """combined (position, name, sources) with source_count, has_opportunities and question_ids, in order."""
    has = opportunities.select(F.col("input_index").alias("position"), F.lit(True).alias("_has")).distinct()
    asked = questions.groupBy(F.col("input_index").alias("position")).agg(F.sort_array(F.collect_list("question_id")).alias("question_ids"))
    rows = combined.join(has, "position", "left").join(asked, "position", "left")
    none = F.expr("cast(array() as array<string>)")
    return rows.select("position", "name", F.coalesce(F.size("sources"), F.lit(0)).cast("long").alias("source_count"), F.coalesce("_has", F.lit(False)).alias("has_opportunities"), F.coalesce("question_ids", none).alias("question_ids"))


def first_existing(*layouts: DataFrame, key: str = "run") -> DataFrame:
    """Of each key the rows of the first layout that has any."""
    out, seen = layouts[0], layouts[0].select(key).distinct()
    for rows in layouts[1:]:
        out = out.unionByName(rows.join(seen, key, "left_anti"))
        seen = seen.union(rows.select(key)).distinct()
    return out


def run_name(value: str) -> str:
    """A run's name, which is one segment of a path with the runs' prefix: fixed."""
    if not re.fullmatch(r"discovery_[^/\\]+", value or "") or ".." in value:
        raise ValueError(f"not a run: {value!r}")
    return value


def batch_of(ranges: DataFrame, index: int) -> DataFrame:
    """The files (first, last, ...) whose range holds the index."""
    return ranges.where(F.lit(index).between(F.col("first"), F.col("last")))


def containing(ranges: DataFrame, wanted: DataFrame, width: int = 64) -> DataFrame:
    """ranges joined to each wanted index that they hold, as an equi-join on blocks of width indexes."""
    spread = ranges.withColumn("_block", F.explode(F.sequence(F.expr(f"first div {width}"), F.expr(f"last div {width}"))))
    return wanted.withColumn("_block", F.expr(f"index div {width}")).join(spread, "_block").where("index BETWEEN first AND last").drop("_block")


def question_list(questions: DataFrame) -> DataFrame:
    """question_id with its three indexes and a title."""
    part = lambda i: words.split_triple(F.col("question_id"), i)
    return questions.select("question_id", part(1).alias("input_index"), part(2).alias("goal_index"), part(3).alias("opportunity_index"), words.first_text(F.col("suggestion_title"), F.col("suggestion"), F.col("action"), F.col("goal")).alias("title"))


def document_list(documents: DataFrame) -> DataFrame:
    """Documents with pair_count and sample_question, by instant (none last), type and key."""
    rows = pairs.counts(documents).join(documents.select("doc_key", "qa_type", "cutoff_us"), ["doc_key", "qa_type"])
    return rows.orderBy(F.col("cutoff_us").asc_nulls_last(), "qa_type", "doc_key")


def document(documents: DataFrame, qa_type: str, key: str) -> DataFrame:
    return documents.where((F.col("qa_type") == checked(TYPE, qa_type)) & (F.col("doc_key") == key))


def logs_window(events: DataFrame, center_us: int, before: int = asof.AROUND, after: int = asof.AROUND) -> DataFrame:
    """The events around an instant: side, index and what is available on either side."""
    anchor = events.sparkSession.createDataFrame([(0, center_us)], "anchor_id long, us long")
    return asof.around(events, anchor, before, after).drop("anchor_id")


def log_window(spark: SparkSession, log: str, zones: str, center_us: int, before: int = asof.AROUND, after: int = asof.AROUND) -> DataFrame:
    """The same of a log that is stored in shards with a zone map beside it: only shards near the instant are read."""
    return near.neighbourhood(spark, log, zones, center_us, before, after)
