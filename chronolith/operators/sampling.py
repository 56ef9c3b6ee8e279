"""Samples of an exact size: uniform, and one draw from each of equal runs of a ranking."""

from __future__ import annotations

import math
import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from chronolith.operators.order import numbered, positions


def size_of(rows: int, fraction: float) -> int:
    """At least one of some rows, else the fraction rounded down."""
    if fraction <= 0:
        raise ValueError("the fraction must be greater than 0")
    return rows if fraction >= 1 else min(rows, max(1, math.floor(rows * fraction)))


def drawn(rows: int, fraction: float, seed: object) -> list[int]:
    """Positions that a seeded generator of the standard library draws uniformly."""
    k = size_of(rows, fraction)
    return list(range(rows)) if k >= rows else sorted(random.Random(seed).sample(range(rows), k))


def drawn_by_run(rows: int, fraction: float, seed: object) -> list[int]:
    """One position from each of k equal runs."""
    k = size_of(rows, fraction)
    if k >= rows:
        return list(range(rows))
    rng = random.Random(seed)
    return sorted({rng.randrange(math.floor(i * rows / k), math.floor((i + 1) * rows / k)) for i in range(k)})


def at_positions(rows: DataFrame, chosen: list[int], *order: Column | str) -> DataFrame:
    """The rows at positions of an order, for samples that must repeat a seeded draw; the positions are a sample's size."""
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(i + 1,) for i in chosen], "_position long")
    return numbered(rows, "_position", *order).join(wanted, "_position", "left_semi").drop("_position")


def _key(seed: str, *columns: Column | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.col(c) if isinstance(c, str) else c for c in columns)).cast("binary"))


#: Hexadecimal digits of a hash that tell the bins of a histogram apart.
DIGITS = 4


def least(rows: DataFrame, hashed: Column, key: str, k: Callable[[int], int]) -> DataFrame:
    """The k(number of rows) rows with the least (hashed, key); hashed is a hexadecimal text.

    A histogram of the hashes' first digits shows the bin in which the last of these rows is, a second one by the next
    digits a smaller bin in it; only that one is sorted. The result is a filter of rows, which are neither shuffled nor
    stored."""
    spark = rows.sparkSession
    h, item = F.col("_h"), F.struct("_h", F.col(f"`{key}`").alias("_key"))
    slim = rows.select(hashed.alias("_h"), F.col(f"`{key}`"))
    inside, before, wanted, start = F.lit(True), 0, None, 1
    below = F.lit(False)
    for _ in range(2):
        digits = F.substring(h, start, DIGITS)
        bins = slim.where(inside).groupBy(digits.alias("digits")).agg(F.count("*").alias("n"))  # at most 16 ** DIGITS rows
        bins = bins.withColumn("upto", F.sum("n").over(Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)))
        bins = bins.withColumn("all", F.sum("n").over(Window.partitionBy()))
        if wanted is None:
            total = bins.select("all").first()
            if total is None:
                return rows
            wanted = k(total[0])
            if wanted >= total[0]:
                return rows
        cut = bins.where(F.col("upto") >= wanted - before).orderBy("digits").first()
        below |= inside & (digits < cut.digits)
        inside &= digits == cut.digits
        before += cut.upto - cut.n
        start += DIGITS
    rest = slim.where(inside)
    last = rest.orderBy("_h", key).limit(wanted - before).agg(F.max(item).alias("last"))
    edge = spark.createDataFrame(last.collect(), last.schema)  # a single row
    sizes = rest.crossJoin(F.broadcast(edge)).agg(F.count_if(item < F.col("last")).alias("less"), F.count_if(item == F.col("last")).alias("equal")).first()
    full = rows.withColumn("_h", hashed).crossJoin(F.broadcast(edge))
    equal = wanted - before - sizes.less
    if sizes.equal <= equal:
        return full.where(below | (inside & (item <= F.col("last")))).select(*rows.columns)
    # Rows that repeat both: any of them will do.
    some = full.where(inside & (item == F.col("last"))).limit(equal)
    return full.where(below | (inside & (item < F.col("last")))).unionByName(some).select(*rows.columns)


def uniform(rows: DataFrame, fraction: float, seed: str, key: str) -> DataFrame:
    """An exact share of rows, the ones whose seeded hash of key is least."""
    size_of(1, fraction)
    return least(rows, _key(seed, key), key, lambda n: max(1, math.floor(n * fraction)))


def _placed(rows: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """rows with their number from 1 in the order. Where whole numbers come first nothing is stored."""
    if not all(isinstance(c, str) for c in order) or not isinstance(rows.schema[order[0]].dataType, (IntegerType, LongType)):
        return numbered(rows, name, *order)
    first = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(1 << 63)))  # none comes first
    out = positions(rows.withColumn("_first", first), "_first", list(order[1:]), name)
    return out.withColumn(name, F.col(name) + 1).drop("_first")


def by_run(rows: DataFrame, fraction: float, seed: str, key: str, *order: Column | str) -> DataFrame:
    """One row of each of k equal runs of the order, the one whose seeded hash of key is least; with run."""
    size_of(1, fraction)
    out = _placed(rows, "_position", *order)
    n = rows.count()
    out = out.withColumn("_n", F.lit(n).cast("long")).withColumn("_k", F.lit(max(1, math.floor(n * fraction))).cast("long"))
    # Position p (from 0) lies in run i where floor(i n / k) <= p < floor((i + 1) n / k).
    out = out.withColumn("run", F.expr("(_position * _k + _n - 1) div _n - 1"))
    first = F.row_number().over(Window.partitionBy("run").orderBy(_key(seed, key), key))
    return out.withColumn("_first", first).where("_first = 1").drop("_first", "_position", "_n", "_k")


def staged(rows: DataFrame, start: int, fraction: float, seed: str, key: str, limit: int | None, *order: Column | str) -> DataFrame:
    """Offset, then sample, then limit, in this order."""
    rest = _placed(rows, "_at", *order).where(F.col("_at") > start).drop("_at")
    out = uniform(rest, fraction, seed, key)
    return out if limit is None else out.orderBy(*order).limit(limit)
