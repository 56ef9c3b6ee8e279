"""Positions in a global order, without sending all rows to one task."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.sources.sinks import stored

#: Ranges for each shuffle partition.
SPREAD = 4


#: Sampled rows for each range that a crowded instant is cut into.
SAMPLED = 64
#: Ranges are numbered with room for so many parts in each.
PARTS = 1 << 20


def _quantiles(rows: DataFrame, us: str) -> list[int]:
    count = SPREAD * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = "array(" + ",".join(f"{(i + 1) / count:.9f}D" for i in range(count - 1)) + ")" if count > 1 else "array(0.5D)"
    return rows.agg(F.expr(f"percentile_approx({us}, {shares}, {max(10_000, 20 * count)}) q")).first().q or []


def bounds(rows: DataFrame, us: str) -> list[int]:
    """Instants that divide rows into ranges of about equal size, as many as the session's shuffle partitions ask for: a
    log that holds a day or a century is dealt out alike. An instant that is named again and again has the rows of several
    ranges."""
    return sorted(_quantiles(rows, us))


def crowded(ends: list[int]) -> dict[int, int]:
    """Instants with the rows of several ranges, and of how many."""
    return {us: n for us, n in Counter(ends).items() if n > 1}


def splitters(rows: DataFrame, us: str, ties: list[str], ends: list[int]) -> DataFrame | None:
    """For each crowded instant (us) cuts: tuples of ties that divide its rows into parts of about equal size, of a sample
    that the rows' hashes choose. As many tuples in all as there are ranges at most; None if no instant is crowded."""
    many = crowded(ends)
    if not many or not ties:
        return None
    spark = rows.sparkSession
    wanted = F.broadcast(spark.createDataFrame(list(many.items()), f"`{us}` long, _parts int"))  # fewer rows than ranges
    own = rows.select(us, *ties).join(wanted, us)
    sizes = own.groupBy(us).agg(F.count("*").alias("_n"))
    share = F.col("_parts") * SAMPLED / F.col("_n")
    hashed = F.pmod(F.xxhash64(us, *ties), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = own.join(F.broadcast(sizes), us).where(hashed < share).groupBy(us).agg(F.max("_parts").alias("_parts"), F.array_sort(F.collect_set(F.struct(*ties))).alias("_all"))
    # Of the sorted sample the last tuple of each part but the last one.
    at = F.sequence(F.lit(1), F.col("_parts") - 1)
    cuts = F.array_distinct(F.transform(at, lambda i: F.element_at("_all", F.greatest(F.lit(1), F.floor(i * F.size("_all") / F.col("_parts"))).cast("int"))))
    return stored(sample.select(us, cuts.alias("_cuts")), "splitters")


def range_of(us: Column, ends: list[int]) -> Column:
    """The number of the range that an instant is in: of the ends below it. Two steps of comparisons, not one for each end."""
    ends = sorted({*ends})
    if not ends:
        return F.lit(0)
    step = math.isqrt(len(ends)) + 1
    array = lambda values: F.expr(f"array({','.join(f'{v}L' for v in values)})")
    below = lambda values: F.size(F.filter(values, lambda b: b < us))
    coarse = ends[step - 1 :: step]
    first = below(array(coarse)) * step if coarse else F.lit(0)
    return first + below(F.slice(array(ends), first + 1, step))


def _bases(sizes: DataFrame) -> DataFrame:
    """_range and _base, how many rows the ranges before it hold; sizes has one row a range."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))


def positions(rows: DataFrame, us: str, ties: list[str], name: str = "pos", ends: list[int] | None = None) -> DataFrame:
    """rows with their position, from 0, in the order of us and ties: counts of ranges are summed, and rows numbered within
    their range. The ends of ranges are instants, and where one instant has the rows of several, tuples of ties, so no
    instant is sorted by one task. Rows without an instant have no position and are left out."""
    rows = rows.where(F.col(us).isNotNull())
    names = rows.columns
    ends = bounds(rows, us) if ends is None else ends
    cuts = splitters(rows, us, ties, ends)
    part = F.lit(0)
    if cuts is not None:
        rows = rows.join(F.broadcast(cuts), us, "left")
        part = F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda c: c < F.struct(*ties))) + 1).otherwise(0)
    rows = rows.withColumn("_range", range_of(F.col(us), ends).cast("long") * PARTS + part).select(*names, "_range")
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy(us, *ties)))
    return rows.join(_bases(sizes), "_range").select(*names, (F.col("_base") + F.col("_rank") - 1).cast("long").alias(name))


def counts_until(events: DataFrame, anchors: DataFrame, us: str, key: str, ends: list[int] | None = None) -> DataFrame:
    """anchors (key, us) with n_le: how many events are at or before each. The events of a crowded instant are dealt out by
    hash, its anchors come behind them all."""
    events = events.where(F.col(us).isNotNull())
    ends = bounds(events, us) if ends is None else ends
    many = crowded(ends)
    of = F.coalesce(F.element_at(F.create_map(*(F.lit(x).cast("long" if i % 2 == 0 else "int") for i, x in enumerate(y for item in many.items() for y in item))), F.col(us)), F.lit(0)) if many else F.lit(0)
    dealt = F.when(of > 0, F.pmod(F.xxhash64(*events.columns), of) + 1).otherwise(0)
    one = events.select(F.col(us), F.lit(0).alias("_k"), F.lit(None).cast(anchors.schema[key].dataType).alias(key), dealt.cast("long").alias("_part"))
    other = anchors.where(F.col(us).isNotNull()).select(F.col(us), F.lit(1).alias("_k"), F.col(key), F.when(of > 0, of + 1).otherwise(0).cast("long").alias("_part"))
    both = one.unionByName(other).withColumn("_range", range_of(F.col(us), ends).cast("long") * PARTS + F.col("_part")).drop("_part")
    sizes = both.groupBy("_range").agg(F.sum(1 - F.col("_k")).alias("_n"))
    upto = Window.partitionBy("_range").orderBy(us, "_k").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_seen", F.sum(1 - F.col("_k")).over(upto)).where("_k = 1")
    return both.join(_bases(sizes), "_range").select(key, us, (F.col("_base") + F.col("_seen")).cast("long").alias("n_le"))


def numbered(rows: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """rows with a number from 1 in the given order: they are sorted in ranges, numbered within each, and the sizes of the
    ranges before are added. The sorted rows are stored between the two steps."""
    sorted_rows = rows.orderBy(*order).withColumn("_range", F.spark_partition_id()).withColumn("_rank", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    kept = stored(sorted_rows, "numbered")
    sizes = kept.groupBy("_range").agg(F.count("*").alias("_n"))
    return kept.join(_bases(sizes), "_range").withColumn(name, (F.col("_base") + F.col("_rank") + 1).cast("long")).select(*rows.columns, name)
