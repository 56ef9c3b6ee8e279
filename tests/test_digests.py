"""Change sets by digests, against the comparison of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from chronolith.operators import digests, pairs

SCHEMA = "k long, m string, v double, tags array<string>"


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_changes_are_those_of_all_rows(spark, ranges):
    r = random.Random(ranges)
    old = [(i % 400, r.choice(["a", None]), r.choice([1.0, 2.0, None, float("nan")]), r.choice([None, ["x"], []])) for i in range(900)] + [(None, "a", 1.0, None)]
    new = [x if r.random() < 0.97 else (x[0], x[1], 9.0, x[3]) for x in old if r.random() < 0.98] + [(5000, None, None, None), old[0], old[0]]
    before, after = (spark.createDataFrame(x, SCHEMA).repartition(3) for x in (old, new))
    got = digests.changed(before, after, "k", "m", ranges=ranges)
    assert rows_of(got) == rows_of(pairs.changed(before, after, "k", "m")) and got.columns == after.columns
    kept = digests.leaves(before, "k", "m", ranges=ranges)
    assert rows_of(digests.changed(before.limit(0).unionByName(before), after, "k", "m", ranges=ranges, known=kept)) == rows_of(got)


def test_equal_tables_have_equal_roots_and_nothing_to_compare(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    one, two = digests.leaves(df, "k"), digests.leaves(df.orderBy(F.desc("k")).repartition(5), "k")
    assert digests.root(one) == digests.root(two) is not None and digests.differing(one, two).count() == 0
    other = df.withColumn("v", F.when(F.col("k") == 77, "x").otherwise(F.col("v")))
    assert digests.root(digests.leaves(other, "k")) != digests.root(one) and digests.differing(one, digests.leaves(other, "k")).count() == 1
    twice = digests.leaves(df.unionByName(df.where("k = 5")).unionByName(df.where("k = 5")), "k")
    assert digests.differing(one, twice).count() == 1  # rows that are added in pairs don't cancel
    assert digests.root(digests.leaves(df.limit(0), "k")) is None
    assert digests.changed(df, df, "k").count() == 0 and digests.changed(df.limit(0), df, "k").count() == 3000


def test_only_rows_of_differing_ranges_are_shuffled(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 200).alias("v"))
    other = df.withColumn("v", F.when(F.col("k") == 77, "y").otherwise(F.col("v")))
    there = digests.differing(digests.leaves(df, "k"), digests.leaves(other, "k"))
    inside = other.join(F.broadcast(there), digests.range_of(("k",), digests.RANGES) == there["range"], "left_semi")
    assert inside.count() < 40 and [r.k for r in digests.changed(df, other, "k").collect()] == [77]
