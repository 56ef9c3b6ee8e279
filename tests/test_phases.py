import json

import pytest

from chronolith.operators import api, generate, ingest, pairs
from chronolith.plans import phases
from chronolith.sources import readers, sinks, versions

T0 = 1775600000.5


def test_phases_run_in_order_and_stop_at_a_failure():
    done = []
    modes = {m: (lambda m=m: done.append(m)) for ms in phases.PHASES.values() for m in ms}
    out = phases.run("all", modes)
    assert done == [m for ms in phases.PHASES.values() for m in ms] and {s["status"] for s in out["stages"].values()} == {"done"}
    done.clear()
    assert set(phases.run("02", modes, dry_run=True)["stages"]) == {"themes", "combined", "links"} and done == []
    with pytest.raises(ZeroDivisionError):
        phases.run("all", {**modes, "manifest": lambda: 1 / 0})
    assert done == ["indexing", "intervals", "interval_qa", "themes", "combined", "links", "opportunities"]
    assert phases.PHASES["05"] == ("seed_qa", "training_rows")  # what is exported is what was made
    for phase, some in (("06", modes), ("01", {})):
        with pytest.raises(ValueError):
            phases.run(phase, some)


@pytest.mark.parametrize("options", [{"fraction": 0}, {"fraction": 1.5}, {"jobs": 0}, {"batch": 0}, {"pairs": 11}, {"pairs": 2, "kind": "seed"}, {"pairs": 8, "kind": "threaded"}])
def test_options_out_of_bounds(options):
    phases.bounds()
    with pytest.raises(ValueError):
        phases.bounds(**options)


def test_channels_and_transcripts_become_one_log(spark, tmp_path):
    for channel, rows in {"screen": [{"timestamp": T0, "text": "a", "source": {"start_time": "s"}}], "email": [{"timestamp": T0, "text": "b"}, {"timestamp": 5, "text": "old"}]}.items():
        (tmp_path / channel).mkdir()
        (tmp_path / channel / "log.jsonl").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "audio").mkdir()
    (tmp_path / "audio" / "2026-04-09_10-00-00.md").write_text("## 10:00:00 - 10:01:00\n[00:01] hello\n")
    logs = {c: str(tmp_path / c) for c in ("screen", "email")}
    for _ in range(2):  # a batch that is replayed changes nothing
        phases.index_all(spark, logs, f"{tmp_path}/shards", f"{tmp_path}/state", 0, transcripts=str(tmp_path / "audio"))
    phases.index_all(spark, logs, f"{tmp_path}/shards", f"{tmp_path}/state", 1, transcripts=str(tmp_path / "audio"))
    got = versions.read(spark, f"{tmp_path}/shards").select("channel", "text").collect()
    assert sorted(map(tuple, got)) == [("audio", "hello"), ("email", "b"), ("screen", "a")]
    with pytest.raises(ValueError):
        phases.events(spark, {})


def test_lines_of_a_file_that_is_read_in_splits(spark, tmp_path):
    (tmp_path / "long.jsonl").write_text("".join(json.dumps({"k": i, "pad": "x" * (i % 50)}) + ("\n" if i % 7 else "\r\n") for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = readers.rows_with_index(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() >= 1 and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert sorted((r.interval_index, json.loads(r.value)["k"]) for r in rows.select("interval_index", "value").collect()) == [(i + 1, i) for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_indented_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"a": 3}, indent=2))
    got = readers.items(readers.documents(spark, str(tmp_path)))
    assert sorted(r.doc.toPython()["a"] for r in got.collect()) == [1, 2, 3]


def test_two_transcripts_keep_their_lines(spark, tmp_path):
    for day in (6, 7):
        (tmp_path / f"2026-04-0{day}_10-00-00.md").write_text(f"head\n## 10:00:00 - 10:01:00\n[00:01] one {day}\n\n## 10:01:00 - 10:02:00\ntwo {day}\n")
    got = ingest.chunks(readers.transcripts(spark, str(tmp_path))).orderBy("us").collect()
    assert [r.text for r in got] == ["one 6", "two 6", "one 7", "two 7"]


def test_calls_are_made_once(spark, tmp_path):
    log = tmp_path / "calls"

    def call(prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        return prompt.upper()

    rows = spark.createDataFrame([(i, f"p{i}") for i in range(4)], "id long, prompt string")
    out = generate.published(generate.run(rows, call))
    assert sorted(r.output for r in out.collect()) == ["P0", "P1", "P2", "P3"] and generate.ledger(out, "id").count() == 4
    assert len(log.read_text().split()) == 4
    with pytest.raises(RuntimeError):
        generate.published(generate.run(rows, lambda p: 1 / 0))
    with pytest.raises(ValueError):
        generate.ranked_at_once(rows, call, "{rows}", "id", most=3)


def test_names_of_runs_and_layouts(spark):
    assert api.run_name("discovery_1") == "discovery_1"
    for bad in ("other", "discovery_", "discovery_a/b", "discovery_..", ""):
        with pytest.raises(ValueError):
            api.run_name(bad)
    new, old = spark.createDataFrame([("r1", 1)], "run string, v int"), spark.createDataFrame([("r1", 2), ("r2", 3)], "run string, v int")
    assert sorted(map(tuple, api.first_existing(new, old).collect())) == [("r1", 1), ("r2", 3)]
    assert sorted(map(tuple, pairs.changed(old, new.union(old.where("v = 3")), "run").collect())) == [("r1", 1)]


def test_off_local_mode_the_shared_folder_must_be_named():
    class Context:
        def __init__(self, master):
            self.master, self.folder = master, None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, named=None):
            self.sparkContext, self.conf = Context(master), {"spark.checkpoint.dir": named}

    with pytest.raises(ValueError):
        sinks.shared_folder(Session("spark://host:7077"))
    assert sinks.shared_folder(Session("spark://host:7077", "hdfs://x/y")) == "hdfs://x/y"
    assert sinks.shared_folder(Session("local[2]"))
