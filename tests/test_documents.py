import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.operators import api, generate, opportunities, pairs, ranking, sampling, themes, validate

CONTEXT = [{"index": 0, "ts": 0.0, "ts_iso": "1970-01-01T00:00:00Z", "channel": "screen", "text": "e"}]


def pair(i=0, basis="H", verify=100_000_000, indexes=(0,), **over):
    made = {"q_id": i, "question": f"q{i}", "answer": f"a{i}", "category": "c", "timescale": "short", "answer_basis": basis, "verify_us": verify, "verify_at_iso": "x", "question_basis": {"context_event_indexes": list(indexes), "reason": "r"}, "why_it_matters": "w", "evidence_grounding": "e", "question_difficulty": 5.0}
    return made | over


def doc(qa_type="recall", flat=None, threads=None, key="d", context=CONTEXT, cutoff=100_000_000):
    return (key, qa_type, cutoff, context, threads, flat)


def thread(k, n, first=0):
    return {"thread_id": k, "qa_pairs": [pair(first + i) for i in range(n)]}


def broken(spark, check, *docs):
    df = spark.createDataFrame(list(docs), pairs.DOCUMENT)
    return [r.violations for r in check(df).collect()]


@pytest.mark.parametrize(
    ("basis", "verify", "ok"),
    [("H", 100_000_400, True), ("H", 101_000_000, False), ("F", 99_000_000, False), ("F", 99_999_500, True), ("H+F", 100_000_000, True), ("G", 100_000_000, False), ("H", None, False)],
)
def test_time_of_the_answer_fits_its_basis(spark, basis, verify, ok):
    got = broken(spark, validate.interval_documents, doc(flat=[pair(0), pair(1), pair(2, basis, verify)]))
    assert got == [[] if ok else ["pair"]]


def test_interval_documents(spark):
    three = [pair(i) for i in range(3)]
    cases = {
        "fine": (doc(flat=three), []),
        "threads": (doc(threads=[thread(0, 3)]), []),
        "sparse": (doc("verbatim_textbox", flat=[]), []),
        "few": (doc(flat=three[:2]), ["pair_count"]),
        "many": (doc(flat=[pair(i) for i in range(11)]), ["pair_count"]),
        "none": (doc(), ["pair_count", "pair"]),
        "type": (doc("other", flat=three), ["qa_type"]),
        "evidence": (doc(flat=[pair(0), pair(1), pair(2, indexes=[3])]), ["pair"]),
        "no evidence": (doc(flat=[pair(0), pair(1), pair(2, indexes=[])]), ["pair"]),
        "context": (doc(flat=three, context=[CONTEXT[0] | {"index": 1}]), ["context"]),
        "text": (doc(flat=[pair(0), pair(1), pair(2, question="")]), ["pair"]),
    }
    got = broken(spark, validate.interval_documents, *(c[0] for c in cases.values()))
    assert dict(zip(cases, got, strict=True)) == {k: v[1] for k, v in cases.items()}


def test_seed_and_question_documents(spark):
    good, long = [thread(0, 3), thread(1, 3), thread(2, 4)], [thread(0, 4), thread(1, 4), thread(2, 4)]
    seeds = [doc("threaded", threads=good), doc("threaded", threads=long), doc("threaded", threads=good[:2]), doc("timing", flat=[pair(i) for i in range(3)]), doc("timing", threads=good)]
    assert broken(spark, validate.seed_documents, *seeds) == [[], ["pair_count"], ["pair_count"], [], ["pair_count", "pair"]]
    swapped = [thread(1, 3), thread(0, 3), thread(2, 3)]
    assert broken(spark, validate.question_documents, doc(threads=long), doc(threads=swapped), doc(threads=[thread(0, 3, 5), *good[1:]])) == [[], ["threads"], ["q_id"]]


def test_strict_raises(spark):
    df = validate.interval_documents(spark.createDataFrame([doc(flat=[])], pairs.DOCUMENT))
    with pytest.raises(PySparkException, match="pair_count"):
        validate.strict(df).collect()


def test_training_rows_and_json(spark):
    docs = [doc(flat=[pair(i) for i in range(3)], key="a"), doc("threaded", threads=[thread(k, 3) for k in range(3)], key="b"), doc(flat=[pair(0)], context=None, key="c"), doc(None, flat=[pair(0, question=None), pair(1, category="")], key="d"), doc(flat=[pair(0)], threads=[], key="e")]
    rows = pairs.training_rows(spark.createDataFrame(docs, pairs.DOCUMENT))
    counts = {r.doc_key: r.n for r in rows.groupBy("doc_key").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 3, "b": 9, "d": 1}
    lines = {r.doc_key: json.loads(r.json) for r in pairs.as_json(rows).where("pair_position = 1").collect()}
    assert set(lines["d"]) == {"answer", "context_events", "q_id", "question", "thread_id"}
    assert list(lines["a"]) == sorted(lines["a"]) and lines["a"]["category"] == "c"
    tricky = doc(None, flat=[pair(0, question=',"category":null,"context_events":', category=None)], key="t")
    line = pairs.as_json(pairs.training_rows(spark.createDataFrame([tricky], pairs.DOCUMENT))).first().json
    assert json.loads(line)["question"] == ',"category":null,"context_events":'


def test_counts_and_categories(spark):
    df = spark.createDataFrame([doc(flat=[pair(0, question=""), pair(1, category=None)]), doc("x", threads=[thread(0, 2)], key="t")], pairs.DOCUMENT)
    assert [(r.pair_count, r.sample_question) for r in pairs.counts(df).collect()] == [(2, "q1"), (2, "q0")]
    assert pairs.attached(df, "pre_").first().qa_pairs[1].category == "pre_recall"


@pytest.mark.parametrize(("rank", "count", "percentile", "value"), [(1, 1, 100.0, 100), (1, 5, 100.0, 100), (3, 5, 50.0, 50), (5, 5, 0.0, 1), (2, 4, 66.67, 67), (3, 9, 75.0, 75)])
def test_percentiles(spark, rank, count, percentile, value):
    df = spark.createDataFrame([(k,) for k in range(1, count + 1)], "rank long")
    row = ranking.percentiles(df).where(F.col("rank") == rank).first()
    assert (row.rank_percentile, row.value_estimate) == (percentile, value)


def test_halves_go_to_even(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (5, 2), (-1, 2), (7, 3), (-3, 2)], "n long, d long")
    assert [r[0] for r in df.select(ranking.half_even(F.col("n"), F.col("d"))).collect()] == [0, 2, 2, 0, 2, -2]


def test_ranking_joins_and_gaps(spark):
    seeds = spark.createDataFrame([("1_0_0", "s1"), ("2_0_0", ""), ("3_0_0", "s3")], "seed_id string, suggestion string")
    ranked = spark.createDataFrame([("2_0_0", 1, "own"), ("1_0_0", 2, "own"), ("9_9_9", 3, None)], "seed_id string, rank long, suggestion string")
    got = {r.seed_id: r.suggestion for r in ranking.enriched(ranked, seeds, "seed_id", "suggestion").collect()}
    assert got == {"2_0_0": "own", "1_0_0": "s1", "9_9_9": None}
    assert [r.seed_id for r in ranking.missing(seeds, ranked, "seed_id").collect()] == ["3_0_0"]
    assert [r.seed_id for r in ranking.unknown(ranked, seeds, "seed_id").collect()] == ["9_9_9"]
    rows = ranking.ranked(ranked.drop("suggestion"), seeds, "seed_id").orderBy("rank").collect()
    assert [(r.seed_id, r.rank_count) for r in rows] == [("2_0_0", 3), ("1_0_0", 3)]


def test_samples(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "k long")
    assert sampling.uniform(df, 0.1, "0", "k").count() == 2 and sampling.uniform(df, 1.0, "0", "k").count() == 25
    assert sampling.uniform(df, 0.001, "0", "k").count() == 1 and sampling.uniform(df.limit(0), 0.1, "0", "k").count() == 0
    runs = sampling.by_run(df, 0.12, "0", "k", "k").collect()
    assert sorted(r.run for r in runs) == [0, 1, 2]
    assert all(r.run * 25 // 3 <= r.k < (r.run + 1) * 25 // 3 for r in runs)
    assert sampling.drawn(25, 0.2, "0") == sorted(random.Random("0").sample(range(25), 5))
    chosen = sampling.drawn_by_run(25, 0.2, "0")
    assert [i // 5 for i in chosen] == [0, 1, 2, 3, 4]
    assert sorted(r.k for r in sampling.at_positions(df, chosen, "k").collect()) == chosen
    with pytest.raises(ValueError):
        sampling.uniform(df, 0, "0", "k")


def test_opportunities(spark):
    batch = [{"input_index": 4, "goals": [None, {"goal": "g", "opportunities": [{"us": 5, "suggestion": "b"}, None, {"us": None, "suggestion": "c"}]}]}]
    rows = opportunities.flattened(opportunities.both_layouts(spark.createDataFrame([(batch,)], f"items {opportunities.BATCH}"), spark.createDataFrame([(9, [{"goal": "h", "opportunities": [{"us": 1, "suggestion": "a"}]}])], "input_index long, goals array<struct<goal:string,opportunities:array<" + opportunities.OPPORTUNITY + ">>>")))
    out = opportunities.sequenced(rows).orderBy("sequence_index").collect()
    assert [(r.sequence_index, r.opportunity_id) for r in out] == [(1, "9_0_0"), (2, "4_1_0"), (3, "4_1_2")]
    lines = opportunities.report(opportunities.sequenced(rows)).orderBy("sequence_index").collect()[2].lines.split("\n")
    assert lines[0] == "## 3. Missing timestamp - Untitled" and "- Suggestion: c" in lines
    batches = opportunities.batched(rows.select("input_index", "suggestion"), 2, "suggestion")
    assert sorted((r.batch, len(r["items"])) for r in opportunities.nested_batches(batches).collect()) == [(0, 2), (1, 1)]


def test_themes_and_links(spark):
    t = spark.createDataFrame([(0, "a", [(5, 1.0), (3, 2.0)]), (1, "b", []), (2, "c", [(None, None)])], "position long, name string, sources array<struct<us:long,usefulness:double>>")
    got = {r.position: (r.us, r.usefulness) for r in themes.theme_inputs(t, ("usefulness",)).collect()}
    assert got == {0: (3, 2.0), 1: (None, None), 2: (None, None)}
    links = spark.createDataFrame([(0, [0, 1], 9), (1, [1, 2], 8), (2, [7], None)], "position long, members array<long>, best_us long")
    assert {r.position: r.us for r in themes.link_times(links, t).collect()} == {0: 3, 1: 8, 2: None}
    assert [r.violations for r in validate.enough_members(links).orderBy("position").collect()] == [[], [], ["members"]]


def test_generation_policy_and_resume(spark):
    rows = spark.createDataFrame([(i,) for i in range(4)], "k long")
    asked = generate.prompts(rows, generate.template("n={k}", ("k",)), k="k")

    def fails(prompt):
        if prompt == "n=2":
            raise RuntimeError("no")
        return generate.stub(prompt)

    done = generate.run(asked, fails, jobs=2)
    assert generate.published(done, keep_going=True).count() == 3
    with pytest.raises(RuntimeError, match="no"):
        generate.published(done)
    assert {r.k for r in generate.todo(asked, done.where("status = 'ok'"), "k").collect()} == {2}
    assert generate.run(asked, generate.command(["cat"])).where("output = prompt").count() == 4
    assert generate.run_batches(rows.withColumn("b", F.col("k") % 2), generate.stub, "{rows}", "b", "k").count() == 2
    with pytest.raises(ValueError):
        generate.template("x", ("k",))
    assert generate.manifest(None, "s", "done")["stages"]["s"]["status"] == "done"


def test_read_queries(spark):
    artifacts = spark.createDataFrame([("r1", "themes", 1, "global"), ("r2", "themes", 2, "days_10"), ("r2", "themes", 3, "days_2"), ("r3", "questions", 9, "days_2")], "run string, stage string, modified long, scope string")
    assert [r.run for r in api.runs(artifacts).collect()] == ["r2", "r1", "r3"]
    assert [r.scope for r in api.scopes(artifacts).orderBy("position").collect()] == ["global", "days_2", "days_10"]
    assert api.latest_run(artifacts).first().run == "r3"
    ranges = spark.createDataFrame([(0, 4), (5, 70), (60, 200)], "first long, last long")
    wanted = spark.createDataFrame([(4,), (65,), (300,)], "index long")
    assert {(r["index"], r.first) for r in api.containing(ranges, wanted).select("index", "first").collect()} == {(4, 0), (65, 5), (65, 60)}
    with pytest.raises(ValueError):
        api.checked(api.SCOPE, "../etc")
    events = spark.createDataFrame([(i, i, "c") for i in range(9)], "us long, seq long, channel string")
    assert api.logs_window(events, 4, 2, 3).count() == 5


def test_text_helpers(spark):
    df = spark.createDataFrame([("/a/b/c.png", "days_10", "1_2_3"), ("/a/b//", "days_2", "7")], "p string, s string, i string").coalesce(1)
    assert [r[0] for r in df.select(words.base_name(F.col("p"))).collect()] == ["c.png", "b"]
    assert [r.s for r in df.orderBy(words.natural_key(F.col("s"))).collect()] == ["days_2", "days_10"]
    assert [r[0] for r in df.select(words.split_triple(F.col("i"), 3)).collect()] == [3, None]
