"""Connected components of an edge table, by alternating large and small stars; nothing is gathered on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: a < b. Large: each node hands its larger neighbours to its smallest; small: its smaller ones.

    The least neighbours are held before the join, so that the join reads two plain exchanges and a hub's rows can be
    split among tasks.
    """
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(turned)
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).where("m < u"))
        # A node without a smaller neighbour keeps its edges.
        out = turned.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u", "left").select(F.coalesce("m", "u").alias("a"), F.col("v").alias("b"))
    else:
        least = cut(turned.groupBy("u").agg(F.min("v").alias("m")))
        out = turned.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """id and root (the least id that it is linked with, directly or not) of every id in edges (a, b long, not null).

    An edge from a node to itself, and an empty table, give nothing. The rounds needed grow with the logarithm of the
    longest path; if so many aren't enough, that is an error.
    """
    e = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        state = e.agg(F.count("*").alias("n"), F.countDistinct("b").alias("d")).first()
        # Done when every node hangs on one root, and no root hangs on another.
        if state.n == state.d and e.select("a").distinct().join(e.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            return e.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(e.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
        e = cut(_star(_star(e, True), False))
    raise RuntimeError(f"components need more than {rounds} rounds")


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index that each of n nodes is linked with, for links i to j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
