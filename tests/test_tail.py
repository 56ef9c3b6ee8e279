"""Streams of files with cursors as state, against batches."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronolith.sources import versions
from chronolith.streaming import incremental, tail

SCHEMA = "channel string, us long, seq long, text string"


def rows_of(df):
    return sorted((r.channel, r.us, r.seq) for r in df.select("channel", "us", "seq").collect())


def test_cursors_in_the_state_store_are_those_of_batches(spark, tmp_path):
    """Ties, late rows, rows without an instant, a restart after each batch and one batch that fails half-way."""
    r = random.Random(7)
    batches = [[(r.choice("abc"), r.choice([None, 5, *range(8 * k, 8 * k + 12)]), 10 * k + r.randrange(14), "t") for _ in range(30)] for k in range(4)]
    source = f"{tmp_path}/in"
    fails = [2]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, SCHEMA)
        incremental.index_batch(df, f"{tmp_path}/log1", f"{tmp_path}/state1", k, late=f"{tmp_path}/late1", default_us=3)
        df.coalesce(1).write.mode("append").parquet(source)
        real = versions.add
        if k in fails:  # the log has its part, then the batch breaks off

            def once(rows, path, *more, **options):
                if path.endswith("late2"):
                    raise RuntimeError("lost")
                return real(rows, path, *more, **options)

            versions.add = once
            try:
                with pytest.raises(Exception):  # noqa: B017
                    tail.index(spark.readStream.schema(SCHEMA).parquet(source), f"{tmp_path}/log2", f"{tmp_path}/late2", f"{tmp_path}/cp", 3).awaitTermination(120)
            finally:
                versions.add = real
        tail.index(spark.readStream.schema(SCHEMA).parquet(source), f"{tmp_path}/log2", f"{tmp_path}/late2", f"{tmp_path}/cp", 3).awaitTermination(120)
        for name in ("log", "late"):
            one, two = (versions.read(spark, f"{tmp_path}/{name}{n}") for n in (1, 2))
            assert sorted(map(str, one.select("channel", "us", "seq").collect())) == sorted(map(str, two.select("channel", "us", "seq").collect()))


def test_files_that_come_between_triggers(spark, tmp_path):
    log = tmp_path / "log"
    for channel in ("screen", "email"):
        (log / channel).mkdir(parents=True)

    def put(channel, name, *rows):
        (log / channel / name).write_text("\n\n".join(json.dumps(x) for x in rows) + "\r\n")

    def turn():
        tail.index(tail.channel_log(spark, str(log), cutover_us=0), f"{tmp_path}/shards", f"{tmp_path}/late", f"{tmp_path}/cp", 0).awaitTermination(120)
        return sorted((r.channel, r.text, r.line_no) for r in versions.read(spark, f"{tmp_path}/shards").collect())

    put("screen", "day-1.jsonl", {"timestamp": 10, "text": "a"}, {"timestamp": 10, "text": "b"})
    put("email", "day-1.jsonl", {"timestamp": 11})
    assert turn() == [("email", "", 1), ("screen", "a", 1), ("screen", "b", 3)]
    put("screen", "day-2.jsonl", {"timestamp": 10, "text": "tie"}, {"timestamp": 9, "text": "late"}, {"timestamp": 12, "text": "c"})
    assert turn() == turn() == [("email", "", 1), ("screen", "a", 1), ("screen", "b", 3), ("screen", "c", 5), ("screen", "tie", 1)]
    assert [r.text for r in versions.read(spark, f"{tmp_path}/late").collect()] == ["late"]
    put("email", "day-2.jsonl", {"time": 12})
    with pytest.raises(PySparkException, match="day-2.jsonl, line 1"):
        turn()


@pytest.mark.parametrize("last", [11, 12])
def test_rows_that_are_held_up_come_late_whichever_is_last(spark, tmp_path, last):
    """The last row of the log before the held-up ones end is itself one of them, or is none."""
    from chronolith.plans import catalogue

    duckdb = pytest.importorskip("duckdb")
    seqs = [*range(1, 11), 22, 23, last, 33, 45, 46]
    days = [*range(1, 11), 12, 13, 20, 22, 23, 28]
    rows = [(seq, f"2024-01-{day:02d} 12:00:00", 1, "view" if k != 3 else "click", 1.0, "{}") for k, (seq, day) in enumerate(zip(seqs, days, strict=True))]
    made = spark.createDataFrame(rows, "event_id long, at string, user_id long, event_type string, value double, props string")
    made.select("event_id", F.col("at").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted(tuple(r) for r in catalogue.queries()["tailed_logs"](spark, str(tmp_path)).select("channel", "n", "seqs", "found").collect())
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        assert got == sorted(c.execute(f"SELECT channel, n, seqs, found FROM ({catalogue.oracle_sql()['tailed_logs']})").fetchall())
