import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronolith.operators import asof

DAY = 86_400_000_000


def frames(spark, events, anchors):
    e = spark.createDataFrame([(u, i, "ab"[i % 2], f"t{i}") for i, u in enumerate(events)], "us long, seq long, channel string, text string")
    return e, spark.createDataFrame(list(enumerate(anchors)), "anchor_id long, us long")


def test_last_hundred_of_two_channels(spark):
    e, a = frames(spark, range(150), [119])
    rows = sorted((r["index"], r.us) for r in asof.context_rows(e, a).collect())
    assert rows == [(i, 20 + i) for i in range(100)]


def test_cutoff_is_inclusive_and_early_anchors_are_empty(spark):
    e, a = frames(spark, [10, 20, 20, 30], [20, 9, 31])
    got = {r.anchor_id: [x.us for x in r.context] for r in asof.contexts(e, a, 10).collect()}
    assert got == {0: [10, 20, 20], 1: [], 2: [10, 20, 20, 30]}
    with pytest.raises(ValueError):
        asof.context_rows(e, a, 0)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 5), min_size=1, max_size=25), st.lists(st.integers(-1, 6), min_size=1, max_size=5), st.integers(1, 6), st.integers(0, 4), st.integers(0, 4))
def test_against_scanning(spark, events, anchors, limit, before, after):
    events, anchors = [u * DAY // 2 for u in events], [u * DAY // 2 for u in anchors]
    e, a = frames(spark, events, anchors)
    order = sorted(range(len(events)), key=lambda i: (events[i], i))
    want = {(k, j, s) for k, c in enumerate(anchors) for j, s in enumerate([i for i in order if events[i] <= c][-limit:])}
    assert {(r.anchor_id, r["index"], r.seq) for r in asof.context_rows(e, a, limit).collect()} == want
    both = set()
    for k, c in enumerate(anchors):
        past, future = [i for i in order if events[i] <= c], [i for i in order if events[i] > c]
        both |= {(k, "past", j, s, len(past), len(future)) for j, s in enumerate(past[-before:] if before else [])}
        both |= {(k, "future", j, s, len(past), len(future)) for j, s in enumerate(future[:after])}
    rows = asof.around(e, a, before, after).collect()
    assert {(r.anchor_id, r.side, r["index"], r.seq, r.before_available, r.after_available) for r in rows} == both
