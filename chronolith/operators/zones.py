"""Zone maps of a sharded log: of each shard its least and greatest instant and its rows, and lookups that read few shards.

The log is a versioned table whose parts are partitioned by channel and local day (streaming.incremental). Its zone map is
a versioned table beside it with a part for each part of the log, so a batch adds the zones of its own shards only, and
compaction replaces those of what it has brought together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolith.sources import versions

#: What names a shard: the folder of the part, and the partition's values.
SHARD = ("folder", "channel", "local_day")


def of_log(rows: DataFrame, *shard: str) -> DataFrame:
    """shard with least, greatest (instants) and n (rows that have an instant)."""
    return rows.where(F.col("us").isNotNull()).groupBy(*shard).agg(F.min("us").alias("least"), F.max("us").alias("greatest"), F.count("*").alias("n"))


def refreshed(spark: SparkSession, log: str, zones: str) -> DataFrame:
    """The zone map (SHARD, least, greatest, n) of the log's latest version; parts that have none yet are read for it."""
    parts = {p["folder"]: name for name, p in versions.state(spark, log)["parts"].items()}
    known = versions.state(spark, zones)["parts"]
    for folder in parts:
        if folder not in known:
            rows = spark.read.parquet(f"{log}/{folder}").withColumn("folder", F.lit(folder)).withColumn("local_day", F.col("local_day").cast("string"))
            versions.add(of_log(rows, *SHARD), zones, folder, lambda df, to: df.coalesce(1).write.parquet(to), drop=lambda n: n not in parts)
    return versions.read(spark, zones)


def needed(zones: DataFrame, center_us: int, before: int, after: int) -> DataFrame:
    """Of the zones those that can hold one of the last rows up to an instant or of the first after it, with past: how many
    rows of all zones that end before any of these are at or before it.

    Among shards that begin at B or later and end by the instant there are enough rows: then no earlier row than B is
    wanted, so shards that end before B aren't. Likewise on the other side. The windows are over one row a shard."""
    c = F.lit(center_us)
    is_past, is_future = F.col("greatest") <= c, F.col("least") > c
    upto = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = zones.withColumn("_back", F.sum(F.when(is_past, F.col("n")).otherwise(0)).over(upto(F.desc("least"), *SHARD)))
    rows = rows.withColumn("_on", F.sum(F.when(is_future, F.col("n")).otherwise(0)).over(upto(F.asc("greatest"), *SHARD)))
    bound = rows.agg(
        F.max(F.when(is_past & (F.col("_back") >= before), F.col("least"))).alias("_from"),
        F.min(F.when(is_future & (F.col("_on") >= after), F.col("greatest"))).alias("_to"),
        F.sum("n").alias("total"),
    )
    rows = rows.drop("_back", "_on").crossJoin(F.broadcast(bound))  # a single row
    out = ~is_past & ~is_future
    out = out | (is_past & (F.coalesce(F.col("greatest") >= F.col("_from"), F.lit(True)) if before else F.lit(False)))
    out = out | (is_future & (F.coalesce(F.col("least") <= F.col("_to"), F.lit(True)) if after else F.lit(False)))
    left_out = F.sum(F.when(is_past & ~out, F.col("n")).otherwise(0)).over(Window.partitionBy())
    return rows.withColumn("_out", out).withColumn("past", left_out).where("_out").select(*SHARD, "least", "greatest", "n", "past", "total")


def neighbourhood(spark: SparkSession, log: str, zones: str, center_us: int, before: int = 200, after: int = 200, ties: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The last events of the log up to an instant and the first after it: the events' columns, side (past or future), index,
    before_available and after_available, as asof.around has them. Of the log only the shards near the instant are read."""
    if before < 0 or after < 0:
        raise ValueError("before and after must not be negative")
    chosen = needed(refreshed(spark, log, zones), center_us, before, after).collect()  # a few shards
    state = versions.state(spark, log)
    rows = versions.read(spark, log, state["version"])
    if not chosen:
        return rows.limit(0).select("*", *(F.lit(v).alias(n) for n, v in (("before_available", 0), ("after_available", 0))), F.lit("past").alias("side"), F.lit(0).cast("long").alias("index"))
    spots: dict[str, list] = {}
    for r in chosen:
        spots.setdefault(r.folder, []).append((r.channel, r.local_day))
    # One scan for each part that is needed, of the partitions that are needed there.
    near = None
    for folder, shards in sorted(spots.items()):
        condition = F.lit(False)
        for channel, day in shards:
            condition |= F.col("channel").eqNullSafe(F.lit(channel)) & F.col("local_day").cast("string").eqNullSafe(F.lit(day))
        part = versions.part(spark, log, folder, rows.schema).where(condition)
        near = part if near is None else near.unionByName(part)
    near = near.where(F.col("us").isNotNull())
    is_past = F.col("us") <= center_us
    counts = near.agg(F.sum(is_past.cast("long")).alias("n")).first()
    available, total = chosen[0].past + (counts.n or 0), chosen[0].total
    order = ["us", *ties]
    past = near.where(is_past).orderBy(*(F.desc(c) for c in order)).limit(before)
    future = near.where(~is_past).orderBy(*order).limit(after)
    at = F.row_number().over(Window.orderBy(*order)) - 1  # over as many rows as are asked for
    both = [df.withColumn("side", F.lit(side)).withColumn("index", at.cast("long")) for df, side in ((past, "past"), (future, "future"))]
    out = both[0].unionByName(both[1])
    return out.withColumn("before_available", F.lit(available).cast("long")).withColumn("after_available", F.lit(total - available).cast("long"))
