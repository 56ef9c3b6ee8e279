import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronolith.operators import intervals

W = 60_000_000


def expected(stamps, include_empty):
    """Buckets by walking the sorted log, as the definition has it."""
    if not stamps:
        return []
    lo, hi = min(stamps), max(stamps)
    n = max(1, math.ceil((hi - lo) / W))
    counts = Counter(min((s - lo) // W, n - 1) for s in stamps)
    rows = [(lo + b * W, min(lo + (b + 1) * W, hi), counts[b]) for b in range(n) if include_empty or counts[b]]
    return [(i, *r) for i, r in enumerate(rows)]


def made(spark, stamps, include_empty=False):
    df = spark.createDataFrame([(s, "ab"[k % 2]) for k, s in enumerate(stamps)], "us long, channel string")
    return sorted((r.interval_index, r.start_us, r.end_us, r.event_count) for r in intervals.activity(df, W, include_empty).collect())


@pytest.mark.parametrize("stamps", [[5], [0, W], [0, W, 2 * W], [0, 2 * W - 1], [0, 0, 0], [0, 10 * W], [3, W + 3, 5 * W + 2]])
@pytest.mark.parametrize("include_empty", [False, True])
def test_edges(spark, stamps, include_empty):
    assert made(spark, stamps, include_empty) == expected(stamps, include_empty)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 12 * W), min_size=1, max_size=20))
def test_any_log(spark, stamps):
    assert made(spark, stamps) == expected(stamps, False)


def test_empty_log_and_missing_instants(spark):
    df = spark.createDataFrame([(None, "a")], "us long, channel string")
    assert intervals.activity(df, W).count() == 0
    assert intervals.activity(df, W, include_empty=True).count() == 0


def test_channel_counts_sum_to_events(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a")], "us long, channel string")
    row = intervals.activity(df, W).first()
    assert dict(row.channel_counts) == {"a": 2, "b": 1} and row.event_count == 3


def test_selectors(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "interval_index long")
    take = lambda *a: [r[0] for r in intervals.selected(df, *a).collect()]
    assert take("2-7", 1, 3) == [3, 4, 5] and take(None, 8) == [8, 9] and take("2-7", 0, 0) == []
    assert [r[0] for r in df.where(intervals.in_ranges("interval_index", intervals.parse_list("0, 3,8-9"))).orderBy("interval_index").collect()] == [0, 3, 8, 9]
    for bad in ("1,2", "5", "7-2", "-1-4", "a-b"):
        with pytest.raises(ValueError):
            intervals.parse_range(bad)


def test_days(spark):
    df = spark.createDataFrame([(0, "2026-04-06T23:50:00", 0), (1, "2026-04-07T00:05:00", 0), (2, "2026-04-07T00:20:00", 0)], "interval_index long, start_local string, start_us long")
    rows = intervals.by_day(df.selectExpr("*", "cast(null as string) start_utc")).orderBy("day_index").collect()
    assert [(r.day_index, r.day, r.intervals, r.label) for r in rows] == [(0, "2026-04-06", 1, "0"), (1, "2026-04-07", 2, "1-2")]
