"""Change sets by digests: tables are compared range by range, and only rows of ranges that differ with each other.

Rows are dealt into ranges by their keys' hash. A range's digest is made of numbers that don't depend on the order of its
rows and add up before they are shuffled, so comparing two tables moves a row for each range and task. The digests of a
table that is kept may be kept beside it: then it is read only where something has changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolith.operators import pairs

#: Ranges of a table: as many rows as its digests have.
RANGES = 4096
#: Ranges under one inner node of the tree.
FANOUT = 64


def _json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns))), {"ignoreNullFields": "false"})


def range_of(keys: tuple[str, ...], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int")


def leaves(df: DataFrame, *keys: str, ranges: int = RANGES) -> DataFrame:
    """range, n and digest of the rows whose keys fall into it; ranges without rows are left out. Two tables must have keys of
    the same types."""
    rows = df.select(range_of(keys, ranges).alias("range"), _json(df).alias("json"))
    one, two = F.xxhash64(F.lit(1), "json"), F.xxhash64(F.lit(2), "json")
    out = rows.groupBy("range").agg(F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.sum(two.cast("decimal(20,0)")).alias("s"))
    return out.select("range", "n", F.md5(F.concat_ws(":", "n", "x", "s")).alias("digest"))


def nodes(found: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level of the tree: range (the node's number), n and digest of so many ranges each."""
    children = F.array_sort(F.collect_list(F.struct("range", "digest")))  # fanout at most
    rows = found.groupBy(F.expr(f"range div {fanout}").cast("int").alias("node")).agg(F.sum("n").alias("n"), F.md5(F.to_json(children)).alias("digest"))
    return rows.select(F.col("node").alias("range"), "n", "digest")


def root(found: DataFrame, fanout: int = FANOUT, ranges: int = RANGES) -> str | None:
    """The digest of the whole table; None of an empty one."""
    while ranges > 1:
        found, ranges = nodes(found, fanout), -(-ranges // fanout)
    first = found.first()
    return first.digest if first else None


def differing(one: DataFrame, other: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """range of the leaves whose digests aren't the same, or which only one side has: those of inner nodes that differ."""
    apart = lambda a, b: a.join(b.withColumnRenamed("digest", "other"), "range", "full_outer").where(~F.col("digest").eqNullSafe(F.col("other"))).select("range")
    upper = apart(nodes(one, fanout).select("range", "digest"), nodes(other, fanout).select("range", "digest")).select(F.col("range").alias("node"))
    below = lambda df: df.select("range", "digest", F.expr(f"range div {fanout}").cast("int").alias("node")).join(F.broadcast(upper), "node", "left_semi").drop("node")
    return apart(below(one), below(other))


def changed(before: DataFrame, after: DataFrame, *keys: str, ranges: int = RANGES, known: DataFrame | None = None) -> DataFrame:
    """The same rows as pairs.changed: of after those that differ from before's of the same keys, or have none there. known:
    the leaves of before, if they have been kept."""
    there = differing(leaves(before, *keys, ranges=ranges) if known is None else known, leaves(after, *keys, ranges=ranges))
    inside = lambda df: df.join(F.broadcast(there), range_of(keys, ranges) == there["range"], "left_semi")  # noqa: E731  at most a row a range
    return pairs.changed(inside(before), inside(after), *keys)
