"""Opportunities: batches of nested results flattened to one row each, in one total order, in batches, as a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.functions import time
from chronolith.operators.order import numbered

OPPORTUNITY = "struct<us:bigint,title:string,suggestion:string,action:string,expected_artifact:string,why_now:string>"
BATCH = f"array<struct<input_index:bigint,goals:array<struct<goal:string,opportunities:array<{OPPORTUNITY}>>>>>"


def flattened(batches: DataFrame, items: str = "items") -> DataFrame:
    """A row for each opportunity of batches (items: input_index, goals of opportunities), with goal_index,
    opportunity_index, opportunity_id and the opportunity's fields. Null members are left out but keep their index."""
    rows = batches.select(F.explode(items).alias("i")).where("i IS NOT NULL").select("i.input_index", F.posexplode("i.goals").alias("goal_index", "g")).where("g IS NOT NULL")
    rows = rows.select("input_index", F.col("goal_index").cast("long").alias("goal_index"), F.col("g.goal").alias("goal"), F.posexplode("g.opportunities").alias("opportunity_index", "o")).where("o IS NOT NULL")
    rows = rows.withColumn("opportunity_index", F.col("opportunity_index").cast("long"))
    return rows.select("input_index", "goal_index", "opportunity_index", words.triple_id(F.col("input_index"), F.col("goal_index"), F.col("opportunity_index")).alias("opportunity_id"), "goal", "o.*")


def both_layouts(batches: DataFrame, singles: DataFrame) -> DataFrame:
    """Batch files and files of one item (input_index, goals) as one table of batches."""
    one = singles.select(F.array(F.struct("input_index", "goals")).alias("items"))
    return batches.select("items").unionByName(one)


def sequenced(rows: DataFrame) -> DataFrame:
    """rows with sequence_index from 1: by instant, none last, then by the three indexes."""
    return numbered(rows, "sequence_index", F.col("us").asc_nulls_last(), "input_index", "goal_index", "opportunity_index")


def batched(rows: DataFrame, size: int, *order: Column | str, name: str = "batch") -> DataFrame:
    """rows with the number, from 0, of their batch of size rows in the given order."""
    out = numbered(rows, "_number", *order)
    return out.withColumn(name, F.expr(f"(_number - 1) div {size}")).drop("_number")


def nested_batches(rows: DataFrame, key: str = "batch", order: str = "input_index") -> DataFrame:
    """A row for each batch with its rows as an array of structs, in order; a batch has a fixed size."""
    item = F.struct(order, *(c for c in rows.columns if c not in (key, order)))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("items"))


def title() -> Column:
    return words.first_text(*(F.col(c) for c in ("title", "suggestion", "action", "expected_artifact", "goal")), default=F.col("opportunity_id"))


def suggestion(own: Column, nested: Column) -> Column:
    """A seed's suggestion, else that of the opportunity that it holds."""
    return words.first_text(own, nested["suggestion"])


def counted(rows: DataFrame) -> DataFrame:
    """How many opportunities there are, how many without an instant, of how many inputs."""
    return rows.agg(F.count("*").alias("seeds"), F.count_if(F.col("us").isNull()).alias("missing_instants"), F.countDistinct("input_index").alias("inputs"))


def report(rows: DataFrame, zone: str = time.LOCAL_ZONE) -> DataFrame:
    """sequence_index and lines, the Markdown section of each opportunity."""
    field = lambda label, c: F.concat(F.lit(f"- {label}: "), F.coalesce(F.col(c), F.lit("")))
    head = F.format_string("## %d. %s - %s", F.col("sequence_index"), time.label(F.col("us"), zone), F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")))
    lines = [head, F.lit(""), F.concat(F.lit("- Source: `"), F.col("opportunity_id"), F.lit("`")), field("Goal", "goal"), field("Suggestion", "suggestion"), field("Why now", "why_now"), field("Action", "action"), field("Expected artifact", "expected_artifact"), F.lit("")]
    evidence = F.lit(None).cast("array<string>")
    if "trigger_evidence" in rows.columns:
        some = F.transform("trigger_evidence", lambda e: F.concat(F.lit("- "), e.cast("string")))
        evidence = F.when(F.size("trigger_evidence") > 0, F.concat(F.array(F.lit("Evidence:"), F.lit("")), some, F.array(F.lit(""))))
    none = F.expr("cast(array() as array<string>)")
    return rows.select("sequence_index", F.array_join(F.concat(F.array(*lines), F.coalesce(evidence, none)), "\n").alias("lines"))
