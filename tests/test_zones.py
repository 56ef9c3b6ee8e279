"""Lookups that read few shards."""

import random

import pytest
from pyspark.sql import functions as F

from chronolith.operators import api, asof, zones
from chronolith.sources import versions
from chronolith.streaming import incremental

DAY = 86_400_000_000
START = 1_704_100_000_000_000


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("log")
    r = random.Random(1)
    rows = [(START + r.randrange(30 * DAY) // 3_600_000_000 * 3_600_000_000, r.choice(["a", "b"]), i) for i in range(3000)]
    paths = f"{folder}/log", f"{folder}/zones", f"{folder}/state"
    df = spark.createDataFrame(rows, "us long, channel string, seq long")
    for k in range(3):
        incremental.index_batch(df.where(F.col("us") < START + (k + 1) * 10 * DAY), paths[0], paths[2], k, default_us=0)
    return *paths, sorted(rows, key=lambda x: (x[0], x[2]))


def wanted(rows, center, before, after):
    past, future = [x for x in rows if x[0] <= center], [x for x in rows if x[0] > center]
    shown = past[len(past) - before :] if before < len(past) else past
    return [("past", i, x[2]) for i, x in enumerate(shown)] + [("future", i, x[2]) for i, x in enumerate(future[:after])], len(past), len(future)


@pytest.mark.parametrize(("center", "before", "after"), [(START + 15 * DAY, 20, 30), (START - DAY, 5, 5), (START + 60 * DAY, 150, 5), (START + 3 * DAY + 7_200_000_000, 200, 0), (START + 10 * DAY, 0, 1), (START + DAY, 5000, 5000)])
def test_neighbourhoods(spark, log, center, before, after):
    path, zone_map, _, rows = log
    got = api.log_window(spark, path, zone_map, center, before, after).collect()
    want, past, future = wanted(rows, center, before, after)
    assert sorted((r.side, r["index"], r.seq) for r in got) == sorted(want) and {(r.before_available, r.after_available) for r in got} <= {(past, future)}
    if before + after == 50:  # the same as without a zone map
        plain = asof.around(versions.read(spark, path), spark.createDataFrame([(0, center)], "anchor_id long, us long"), before, after)
        assert sorted((r.side, r["index"], r.seq) for r in plain.collect()) == sorted(want)


def test_few_shards_are_read(spark, log):
    path, zone_map, state, rows = log
    shards = zones.refreshed(spark, path, zone_map)
    assert shards.count() >= 58
    assert 2 <= zones.needed(shards, START + 15 * DAY, 20, 30).count() <= 6
    plan = zones.neighbourhood(spark, path, zone_map, START + 15 * DAY, 20, 30)._jdf.queryExecution().toString()
    scans = [x for x in plan.split("== Physical Plan ==")[1].splitlines() if "FileScan" in x]
    assert scans and all("PartitionFilters: [" in x and "local_day" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in scans)
    incremental.compact(spark, path)
    after = zones.neighbourhood(spark, path, zone_map, START + 15 * DAY, 20, 30)
    assert sorted((r.side, r.seq) for r in after.collect()) == sorted((s, n) for s, _, n in wanted(rows, START + 15 * DAY, 20, 30)[0])
    assert len(versions.state(spark, zone_map)["parts"]) == 1  # of parts that are no more, zones aren't either
    with pytest.raises(ValueError):
        zones.neighbourhood(spark, path, zone_map, 0, -1, 0)
