"""Samples by the least hashes."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chronolith.operators import order, sampling


def wanted(keys, fraction, seed="s"):
    ranked = sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    return sorted(ranked[: max(1, int(len(keys) * fraction))])


@pytest.mark.parametrize("fraction", [1e-6, 0.013, 0.1, 0.5, 0.999, 1.0])
def test_the_least_hashes(spark, monkeypatch, fraction):
    def never(*_):
        raise AssertionError("nothing is to be stored")

    monkeypatch.setattr(order, "stored", never)
    df = spark.range(4000).select(F.col("id").alias("k"), F.lit("x").alias("_h2")).repartition(5)
    out = sampling.uniform(df, fraction, "s", "k")
    assert sorted(r.k for r in out.collect()) == wanted(range(4000), fraction) and out.columns == df.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


def test_repeated_keys_and_few_bins(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DIGITS", 1)
    r = random.Random(2)
    keys = [r.randrange(40) for _ in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for fraction in (0.002, 0.1, 0.3, 0.77):
        assert sorted(x.k for x in sampling.uniform(df, fraction, "s", "k").collect()) == wanted(keys, fraction)
    assert sampling.uniform(df.limit(0), 0.5, "s", "k").count() == 0
    with pytest.raises(ValueError):
        sampling.uniform(df, 0, "s", "k")


def test_runs_of_an_order_with_nulls_and_ties(spark):
    rows = [(None if i % 50 == 0 else i // 3, i) for i in range(600)]
    df = spark.createDataFrame(rows, "rank long, k long").repartition(3)
    got = sampling.by_run(df, 0.1, "s", "k", "rank", "k").collect()
    ranked = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = {}
    for p, (_, k) in enumerate(ranked):
        run = ((p + 1) * 60 + 599) // 600 - 1
        want.setdefault(run, []).append((hashlib.md5(f"s:{k}".encode()).hexdigest(), k))
    assert {x.run: x.k for x in got} == {run: min(some)[1] for run, some in want.items()}
