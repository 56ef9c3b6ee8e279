"""Themes and links: nested source rows condensed to one input row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolith.functions import time

SCORES = ("usefulness", "confidence", "disregard")


def earliest(sources: Column, field: str = "us") -> Column:
    """The least instant of an array of structs; null where there is none."""
    return F.array_min(F.transform(sources, lambda s: s[field]))


def highest(sources: Column, field: str) -> Column:
    """The highest score of an array of structs; what isn't a number doesn't count."""
    return F.array_max(F.filter(F.transform(sources, lambda s: s[field]), lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))))


def theme_inputs(themes: DataFrame, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """themes (position, name, sources, context, reasoning, description) as inputs: type, position, name, us, the scores'
    maxima and the texts."""
    return themes.select(
        F.lit("goal").alias("type"),
        "position",
        "name",
        earliest(F.col("sources")).alias("us"),
        *(highest(F.col("sources"), s).cast("double").alias(s) for s in scores),
        *(c for c in ("context", "reasoning", "description") if c in themes.columns),
    )


def link_times(links: DataFrame, themes: DataFrame) -> DataFrame:
    """links (position, members: array of theme positions, best_us) with us: the earliest instant of the themes that they
    name, else best_us. Positions that no theme has don't count."""
    bounds = themes.select(F.col("position").alias("member"), earliest(F.col("sources")).alias("theme_us"))
    each = links.select("position", F.explode("members").alias("member")).join(bounds, "member")
    found = each.groupBy("position").agg(F.min("theme_us").alias("members_us"))
    return links.join(found, "position", "left").withColumn("us", F.coalesce("members_us", "best_us")).drop("members_us")


def sorted_inputs(inputs: DataFrame) -> DataFrame:
    """inputs with input_index: by instant (none last), themes before links, then position."""
    from chronolith.operators.order import numbered

    kind = F.when(F.col("type") == "goal", 0).otherwise(1)
    out = numbered(inputs, "input_index", F.col("us").asc_nulls_last(), kind, "position")
    return out.withColumn("input_index", F.col("input_index") - 1)


def missing_fields(rows: DataFrame, *fields: str) -> Column:
    """Names of the required texts that are null or empty."""
    return F.array_compact(F.array(*(F.when(F.coalesce(F.col(f), F.lit("")) == "", f) for f in fields)))


def with_iso(inputs: DataFrame) -> DataFrame:
    return inputs.withColumn("time", time.iso_short(F.col("us")))
