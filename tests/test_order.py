"""Positions where many rows share an instant."""

import random
from collections import Counter

from pyspark.sql import functions as F

from chronolith.operators import order


def test_positions_of_crowded_instants(spark):
    r = random.Random(3)
    rows = [(r.choice([5, 5, 5, 5, 7, r.randrange(100), None]), r.choice(["x", "y", None]), i) for i in range(3000)] + [(5, "x", 1)] * 3
    df = spark.createDataFrame(rows, "us long, path string, line_no long").repartition(6)
    ends = order.bounds(df.where("us IS NOT NULL"), "us")
    assert order.crowded(ends).get(5, 0) >= 4 and order.crowded([]) == {}
    got = order.positions(df, "us", ["path", "line_no"]).collect()
    key = lambda x: (x[0], x[1] is not None, x[1] or "", x[2])
    want = sorted((x for x in rows if x[0] is not None), key=key)
    assert sorted(x.pos for x in got) == list(range(len(want)))
    assert [key((x.us, x.path, x.line_no)) for x in sorted(got, key=lambda x: x.pos)] == [key(x) for x in want]


def test_one_instant_is_dealt_out_to_all_ranges(spark):
    df = spark.createDataFrame([(42, i * 7 % 5000) for i in range(5000)], "us long, seq long").repartition(4)
    ends = order.bounds(df, "us")
    cuts = order.splitters(df, "us", ["seq"], ends).first()._cuts
    parts = Counter(sum(c.seq < i for c in cuts) for i in range(5000))
    assert len(parts) >= 0.8 * len(ends) and max(parts.values()) < 3 * 5000 / len(parts)
    got = order.positions(df, "us", ["seq"], ends=ends).collect()
    assert all(x.pos == x.seq for x in got)
    anchors = spark.createDataFrame([(k, us) for k, us in enumerate([41, 42, 42, 43])], "anchor_id long, us long")
    assert {x.anchor_id: x.n_le for x in order.counts_until(df, anchors, "us", "anchor_id").collect()} == {0: 0, 1: 5000, 2: 5000, 3: 5000}
    assert order.positions(df.limit(0), "us", ["seq"]).count() == 0


def test_counts_among_ties(spark):
    r = random.Random(9)
    rows = [(r.choice([3, 3, 3, r.randrange(20)]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "us long, seq long")
    anchors = spark.createDataFrame([(k, k) for k in range(-1, 22)], "anchor_id long, us long")
    got = {x.anchor_id: x.n_le for x in order.counts_until(df, anchors.withColumn("us", F.col("us")), "us", "anchor_id").collect()}
    assert got == {k: sum(us <= k for us, _ in rows) for k in range(-1, 22)}
