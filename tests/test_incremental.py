from chronolith.sources import versions
from chronolith.streaming import incremental

SCHEMA = "us long, channel string, seq long"


def shards(spark, path):
    return sorted((r.us, r.channel, r.seq) for r in versions.read(spark, path).select("us", "channel", "seq").collect())


def test_cursor_orders_ties_and_sets_late_rows_aside(spark):
    first = spark.createDataFrame([(5, "a", 1), (5, "a", 2), (9, "b", 1)], SCHEMA)
    cursor = incremental.cursors(first)
    more = spark.createDataFrame([(5, "a", 3), (5, "a", 2), (4, "a", 9), (1, "c", 1), (7, "c", 2)], SCHEMA)
    fresh, late = incremental.split(more, cursor, default_us=2)
    assert {tuple(r) for r in fresh.select("us", "channel", "seq").collect()} == {(5, "a", 3), (7, "c", 2)}
    assert late.count() == 3
    assert {r.channel: r.pending for r in incremental.pending(more, cursor, 2).collect()} == {"a": 1, "c": 1}
    assert {(r.channel, r.us, r.seq) for r in incremental.advanced(cursor, incremental.cursors(fresh)).collect()} == {("a", 5, 3), ("b", 9, 1), ("c", 7, 2)}


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    log, state = f"{tmp_path}/log", f"{tmp_path}/state"
    one = spark.createDataFrame([(10, "a", 1), (11, "b", 1)], SCHEMA)
    two = spark.createDataFrame([(11, "a", 2), (10, "a", 1)], SCHEMA)
    for _ in range(2):
        incremental.index_batch(one, log, state, 0, default_us=0)
    for _ in range(2):
        incremental.index_batch(two, log, state, 1, late=f"{tmp_path}/late", default_us=0)
    assert shards(spark, log) == [(10, "a", 1), (11, "a", 2), (11, "b", 1)]
    assert versions.read(spark, f"{tmp_path}/late").count() == 1


def test_a_limit_loses_no_tie(spark, tmp_path):
    rows = spark.createDataFrame([(10, "a", 1), (10, "a", 2), (10, "a", 3)], SCHEMA)
    for batch in range(2):
        incremental.index_batch(rows, f"{tmp_path}/log", f"{tmp_path}/state", batch, default_us=0, limit=2)
    assert [s for _, _, s in shards(spark, f"{tmp_path}/log")] == [1, 2, 3]


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    source = tmp_path / "in"
    for k, rows in enumerate(([(10, "a", 1)], [(11, "a", 2), (9, "a", 0)])):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        query = incremental.index_stream(stream, f"{tmp_path}/log", f"{tmp_path}/state", f"{tmp_path}/cp", default_us=0)
        query.awaitTermination(60)
        assert len(shards(spark, f"{tmp_path}/log")) == k + 1
        assert incremental.progress(query)["batchId"] == k
