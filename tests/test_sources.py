import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chronolith.functions import time
from chronolith.operators import ingest
from chronolith.sources import readers, sinks

T0 = 1775600000.5


def test_channel_log_keeps_numbers_from_the_cutover_on(spark, tmp_path):
    rows = [{"timestamp": T0, "text": "a", "source": {"k": 1}}, {"timestamp": 5, "text": "old"}, {"text": "no time"}, {"timestamp": "1775600001"}, {"timestamp": 1775600002}]
    (tmp_path / "log.jsonl").write_text("\n\n".join(map(json.dumps, rows)) + "\n")
    got = readers.channel_logs(spark, str(tmp_path)).orderBy("us").collect()
    assert [(r.us, r.text) for r in got] == [(1775600000500000, "a"), (1775600002000000, "")]


def test_malformed_lines_fail_or_are_skipped(spark, tmp_path):
    (tmp_path / "screen").mkdir()
    (tmp_path / "screen" / "d.jsonl").write_text('{"ts": 1, "text": "x"}\n{bad\n[1]\n{"text": "no ts"}\n{"ts": "2026-04-07T10:00:00Z", "source": {"title": "T"}}\n')
    with pytest.raises(PySparkException):
        readers.channel_logs(spark, str(tmp_path / "screen")).collect()
    got = readers.event_log(spark, str(tmp_path)).orderBy("us", "path", "line_no").collect()
    assert [(r.us, r.channel, r.text, r.line_no) for r in got] == [(1_000_000, "screen", "x", 1), (1775556000000000, "screen", "T", 5)]
    assert got[0].ts_iso == "1970-01-01T00:00:01Z"
    reasons = {r.line_no: r.reason for r in readers.skipped(spark, str(tmp_path)).collect()}
    assert reasons[2] == "malformed" and reasons[3] == "not an object" and reasons[4] == "no instant"


def test_interval_index_defaults_to_the_line(spark, tmp_path):
    (tmp_path / "i.jsonl").write_text('{"a": 1}\n\n{"interval_index": 7}\n')
    assert [r.interval_index for r in readers.rows_with_index(spark, str(tmp_path)).orderBy("line_no").collect()] == [1, 7]


def test_documents_arrays_and_objects(spark, tmp_path):
    (tmp_path / "goal_3.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "goal_x.json").write_text('{"a": 3}')
    docs = readers.documents(spark, str(tmp_path))
    assert readers.items(docs).count() == 3
    assert [(r.name, r.n) for r in readers.named(docs, r"goal_(\d+)\.json", "n").collect()] == [("goal_3.json", 3)]
    with pytest.raises(PySparkException):
        readers.documents(spark, str(tmp_path), kind="ARRAY").collect()


def test_payloads_of_each_channel(spark):
    def one(channel, source):
        df = spark.createDataFrame([(1775600000500000, "t", json.dumps(source))], "us long, text string, s string").withColumn("source", F.parse_json("s"))
        row = ingest.normalised(df, channel).select("ts_iso", "channel", "text", F.to_json("source").alias("s")).first()
        assert (row.ts_iso, row.channel, row.text) == ("2026-04-07T22:13:20.500Z", channel, "t")
        return json.loads(row.s)

    assert one("screen", {"start_time": "x", "screenshot_path": "/a/b/c.png", "raw_events": [1], "k": 2}) == {"start_time_local": "x", "screenshot_path": "screenshots/c.png", "k": 2}
    assert one("email", {"date": "Sat, 6 Apr 2024 07:05:45 -0700", "k": 1})["date_utc_iso"] == "2024-04-06T14:05:45Z"
    assert one("notifications", {"timestamp": 10})["timestamp"] == 978307210
    assert one("notifications", {"timestamp": "10"})["timestamp"] == "10"
    assert one("filesys", {"k": [1]}) == {"k": [1]}


def test_transcript_chunks_cross_midnight(spark, tmp_path):
    (tmp_path / "2026-04-06_23-50-00.md").write_text("# title\nbefore\n## 23:50:00 – 23:59:00\n[00:01] one\n[00:02:500] two\n\nplain\n## 23:59:00 - 00:10:00\n[00:03] three\n## 00:10:00 — 00:20:00\n")
    (tmp_path / "notes.md").write_text("## 01:00:00 - 02:00:00\n[00:01] no\n")
    rows = ingest.chunks(readers.transcripts(spark, str(tmp_path))).orderBy("us").collect()
    day = 1775458800  # 2026-04-06 00:00 in Los Angeles
    assert [r.us // 1_000_000 - day for r in rows] == [85800, 86340, 87000]
    assert [r.source.duration_s for r in rows] == [540.0, 660.0, 600.0]
    assert [r.text for r in rows] == ["one two plain", "three", ""]
    assert [(x.offset_s, x.text) for x in rows[0].source.lines] == [(1.0, "one"), (2.5, "two")]


def test_transcripts_in_the_gap_and_the_overlap_of_daylight_saving(spark):
    lines = [("2026-03-08_01-00-00.md", 0, "## 02:30:00 - 03:30:00"), ("2026-11-01_01-00-00.md", 0, "## 01:30:00 - 01:40:00")]
    df = spark.createDataFrame(lines, "name string, line_no int, value string")
    got = sorted(r.ts_iso for r in ingest.chunks(df).collect())
    assert got == ["2026-03-08T10:30:00.000Z", "2026-11-01T08:30:00.000Z"]


def test_merge_breaks_ties_by_channel(spark):
    a = spark.createDataFrame([(1, "audio"), (2, "audio")], "us long, channel string")
    b = spark.createDataFrame([(1, "screen"), (1, "email")], "us long, channel string")
    assert [tuple(r) for r in ingest.merged(a, b).collect()] == [(1, "screen"), (1, "email"), (1, "audio"), (2, "audio")]


def test_sinks(spark, tmp_path):
    events = spark.createDataFrame([(1775458800000000 - 1, "screen", "a"), (1775458800000000, "screen", "b")], "us long, channel string, text string")
    sinks.day_shards(events, f"{tmp_path}/log")
    sinks.day_shards(events, f"{tmp_path}/log")
    got = spark.read.parquet(f"{tmp_path}/log")
    assert {(r.local_day.isoformat() if hasattr(r.local_day, "isoformat") else r.local_day, r.n) for r in got.groupBy("local_day").agg(F.count("*").alias("n")).collect()} == {("2026-04-05", 2), ("2026-04-06", 2)}
    line = spark.read.text(sinks.sorted_json(events.coalesce(1), f"{tmp_path}/json")).first()[0]
    assert list(json.loads(line)) == ["channel", "text", "us"]
    assert [r[0] for r in spark.read.text(sinks.text_lines(events, "text", f"{tmp_path}/txt", "us")).collect()] == ["a", "b"]
    assert time.LOCAL_ZONE


def test_what_is_left_out_is_counted_by_the_same_pass(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jsonl").write_text('{"ts": 1, "text": "x"}\n{bad\n[1]\n\n{"text": "no ts"}\n{"ts": 2}\n"text"\n')
    observed = Observation()
    rows = readers.event_log(spark, str(tmp_path), recursive=True, numbered=False, observed=observed)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert sorted(r.us for r in rows.collect()) == [1_000_000, 2_000_000]
    assert observed.get == {"lines": 6, "malformed": 1, "not an object": 2, "no instant": 1}


def test_lines_are_numbered_as_they_are_read_once(spark, tmp_path):
    """Files of many splits, with line ends of several kinds: nothing is read again, and no window runs over lines."""
    values = {f"{n}.txt": [f"{n}{i}" + ("\u2028more" if i % 7 == 0 else "") for i in range(2000 * (k + 1))] for k, n in enumerate("ab")}
    for name, lines in values.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    settings = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "100"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = readers.raw_lines(spark, str(tmp_path), "*.txt")
    finally:
        for key in settings:
            spark.conf.unset(key)
    for name in values:
        (tmp_path / name).unlink()
    got = sorted((r.name, r.line_no, r.value) for r in rows.collect())
    assert got == [(name, i, x) for name in sorted(values) for i, x in enumerate("\n".join(values[name]).replace("\u2028", "\n").split("\n"), 1)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1  # over splits
