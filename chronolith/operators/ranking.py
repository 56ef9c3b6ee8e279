"""Rankings: joined to what they rank, checked for gaps on both sides, with percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed names of the ranking's fields and values.
SCORES = ("user_value", "intervention_value_now", "engagement_pull", "surprise", "personal_relevance", "disregard", "grounding", "self_done_penalty")
POSTURES = ("surface_now", "wait", "stay_quiet")
REASONS = ("none", "self_done", "obvious_next_step", "interruptive", "undergrounded", "stale")
TEXTS = ("timing_reason", "marginal_value_reason", "self_done_reason", "future_check")


def half_even(numerator: Column, denominator: Column) -> Column:
    """The quotient of two whole numbers, the denominator positive, rounded half to even, exactly."""
    whole = F.floor(numerator.cast("decimal(38,0)") / denominator.cast("decimal(38,0)")).cast("long")
    rest = numerator - whole * denominator
    up = (2 * rest > denominator) | ((2 * rest == denominator) & (F.pmod(whole, F.lit(2)) != 0))
    return whole + up.cast("long")


def percentiles(ranking: DataFrame, rank: str = "rank") -> DataFrame:
    """ranking with rank_count, rank_percentile (100 for the first, 0 for the last, two places) and value_estimate (at least
    1). A ranking of one row is at 100."""
    count = F.broadcast(ranking.agg(F.count("*").alias("rank_count")))  # a single row
    rows = ranking.crossJoin(count)
    over, under = F.col("rank_count") - F.col(rank), F.col("rank_count") - 1
    share = lambda scale: F.when(under <= 0, F.lit(scale)).otherwise(half_even(over * scale, F.greatest(under, F.lit(1))))
    return rows.withColumn("rank_percentile", share(10_000) / 100).withColumn("value_estimate", F.greatest(F.lit(1).cast("long"), share(100)))


def enriched(ranking: DataFrame, seeds: DataFrame, key: str, field: str) -> DataFrame:
    """ranking with field taken from seeds where they have one, else its own."""
    found = seeds.select(key, F.nullif(F.col(field), F.lit("")).alias("_found"))
    own = F.col(field) if field in ranking.columns else F.lit(None).cast("string")
    return ranking.join(found, key, "left").withColumn(field, F.coalesce("_found", own)).drop("_found")


def ranked(ranking: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """Rows that both have, seeds' columns and the ranking's with percentiles; order by rank for display."""
    return seeds.join(percentiles(ranking), key)


def missing(seeds: DataFrame, ranking: DataFrame, key: str) -> DataFrame:
    """Seeds that the ranking leaves out."""
    return seeds.join(ranking.select(key), key, "left_anti")


def unknown(ranking: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """Ranked ids that no seed has."""
    return ranking.join(seeds.select(key), key, "left_anti")


def violations(ranking: DataFrame, seeds: DataFrame, key: str = "seed_id") -> DataFrame:
    """ranking with violations, an array of what is wrong with each row; empty where it is right."""
    known = seeds.select(F.col(key), F.lit(True).alias("_known")).distinct()
    rows = ranking.join(known, key, "left").withColumn("_copies", F.count("*").over(Window.partitionBy(key)))
    bad = lambda condition, name: F.when(~F.coalesce(condition, F.lit(False)), F.lit(name))
    checks = [
        bad(F.length(key) > 0, "id"),
        bad(F.col("_known"), "unknown"),
        bad(F.col("_copies") == 1, "duplicate"),
        bad(F.col("rank") > 0, "rank"),
        *(bad(F.col(s).between(1, 10), s) for s in SCORES),
        bad(F.col("intervention_posture").isin(*POSTURES), "intervention_posture"),
        bad(F.col("negative_reason").isin(*REASONS), "negative_reason"),
        *(bad(F.length(t) > 0, t) for t in TEXTS),
    ]
    return rows.withColumn("violations", F.array_compact(F.array(*checks))).drop("_known", "_copies")
