"""Queries that write tables as files and read them back, and those of validators, fallbacks and read queries."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from chronolith.functions import time
from chronolith.operators import api, digests, generate, ingest, intervals, opportunities, pairs, themes, validate
from chronolith.operators.order import positions
from chronolith.operators.pairs import EVENT, PAIR, THREAD
from chronolith.plans import inputs
from chronolith.plans.registered import query
from chronolith.sources import readers, sinks, versions
from chronolith.streaming import incremental, tail

_EV = "ev AS (SELECT epoch_us(ts) AS us, event_type AS channel, event_id AS seq, props, user_id, value FROM events)"
_UTC_SHORT = "strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%S')"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{sinks.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Files written and read back

@query(f"WITH {_EV} SELECT us, props AS text, seq AS k FROM ev WHERE us >= 1705276800000000 AND seq % 5 <> 0")
def channel_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw channel logs as JSON lines; every fifth has a text for a timestamp."""
    e = inputs.events(spark, sf_dir)
    stamp = F.when(F.col("seq") % 5 == 0, F.lit('"1"')).otherwise((F.col("us") / 1_000_000).cast("decimal(20,6)").cast("string"))
    line = F.concat(F.expr("substr(to_json(struct(props)), 1, length(to_json(struct(props))) - 1)"), F.lit(', "text": '), F.expr("substr(to_json(struct(props)), 10, length(to_json(struct(props))) - 10)"), F.lit(', "timestamp": '), stamp, F.lit(', "source": {"k": '), F.col("seq").cast("string"), F.lit("}}"))
    path = _folder(spark, "channel-log")
    e.select(line.alias("value")).write.text(path)
    rows = readers.channel_logs(spark, path, 1_705_276_800_000_000, pattern="*.txt")
    return rows.select("us", "text", F.try_variant_get("source", "$.k", "bigint").alias("k"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 ELSE row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) END AS interval_index FROM customer""")
def indexed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file a nation, a customer a line; two of three lines have no index and get their number."""
    c = inputs.table(spark, sf_dir, "customer")
    own = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(', "interval_index": '), (F.col("c_custkey") * 10).cast("string"))).otherwise("")
    line = F.concat(F.lit('{"k": '), F.col("c_custkey").cast("string"), own, F.lit("}"))
    path = _folder(spark, "indexed")
    c.select("c_nationkey", "c_custkey", line.alias("value")).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    rows = readers.rows_with_index(spark, path, pattern="*.txt", recursive=True)
    return rows.select(F.try_variant_get("doc", "$.k", "bigint").alias("c_custkey"), "interval_index")


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """Folders by channel; of ten lines one is broken, one a list and one without an instant."""
    e = inputs.events(spark, sf_dir)
    text = F.when(F.col("seq") % 3 == 0, F.concat(F.lit('"source": {"title": "T'), F.col("seq").cast("string"), F.lit('"}'))).otherwise(F.concat(F.lit('"text": "x'), F.col("seq").cast("string"), F.lit('"')))
    named = F.when(F.col("seq") % 2 == 0, F.concat(F.lit(', "channel": "'), F.col("channel"), F.lit('"'))).otherwise("")
    stamp = F.when(F.col("seq") % 10 == 9, "").otherwise(F.concat(F.lit(', "ts": '), (F.col("us") / 1_000_000).cast("decimal(20,6)").cast("string")))
    line = F.when(F.col("seq") % 10 == 7, "{bad").when(F.col("seq") % 10 == 8, "[1]").otherwise(F.concat(F.lit("{"), text, named, stamp, F.lit("}")))
    path = _folder(spark, "event-log")
    e.select(F.col("channel").alias("folder"), line.alias("value")).write.partitionBy("folder").text(path)
    return path


@query(f"""WITH {_EV} SELECT us, CASE WHEN seq % 2 = 0 THEN channel ELSE 'folder=' || channel END AS channel, CASE WHEN seq % 3 = 0 THEN 'T' ELSE 'x' END || seq AS text,
  {_UTC_SHORT} || CASE WHEN us % 1000000 = 0 THEN 'Z' ELSE '.' || lpad(CAST(us % 1000000 AS VARCHAR), 6, '0') || 'Z' END AS ts_iso FROM ev WHERE seq % 10 < 7""")
def event_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.event_log(spark, _event_files(spark, sf_dir), pattern="*.txt").select("us", "channel", "text", "ts_iso")


@query(f"""WITH {_EV}, f AS (SELECT seq, channel, us - us % 86400000000 AS day, row_number() OVER (PARTITION BY channel ORDER BY seq) AS line_no FROM ev)
SELECT seq, 'folder=' || channel AS folder, line_no, day, row_number() OVER (ORDER BY day, channel, line_no) - 1 AS pos FROM f""")
def event_log_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a log's scan by instant, file and line: one file a channel, and all events of a day at one instant."""
    e = inputs.events(spark, sf_dir)
    day = F.col("us") - F.col("us") % 86_400_000_000
    line = F.concat(F.lit('{"text": "'), F.col("seq").cast("string"), F.lit('", "ts": '), (day / 1_000_000).cast("decimal(20,6)").cast("string"), F.lit("}"))
    path = _folder(spark, "event-order")
    e.select(F.col("channel").alias("folder"), "seq", line.alias("value")).repartition("folder").sortWithinPartitions("folder", "seq").select("folder", "value").write.partitionBy("folder").text(path)
    log = sinks.stored(readers.event_log(spark, path, pattern="*.txt").select("us", "channel", "text", "path", "line_no"), "event-order")
    rows = positions(log, "us", ["path", "line_no"])
    return rows.select(F.col("text").cast("long").alias("seq"), F.col("channel").alias("folder"), "line_no", F.col("us").alias("day"), "pos")


@query("SELECT CASE event_id % 10 WHEN 7 THEN 'malformed' WHEN 8 THEN 'not an object' ELSE 'no instant' END AS reason, count(*) AS n FROM events WHERE event_id % 10 > 6 GROUP BY 1")
def event_log_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.skipped(spark, _event_files(spark, sf_dir), pattern="*.txt").groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT unnest(['lines', 'malformed', 'not an object', 'no instant', 'kept']) AS counted,
  unnest([count(*), count(*) FILTER (event_id % 10 = 7), count(*) FILTER (event_id % 10 = 8), count(*) FILTER (event_id % 10 = 9), count(*) FILTER (event_id % 10 < 7)]) AS n FROM events""")
def event_log_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a log's scan keeps and leaves out, counted by the pass that writes the events."""
    observed = Observation()
    rows = readers.event_log(spark, _event_files(spark, sf_dir), recursive=True, pattern="*.txt", numbered=False, observed=observed)
    kept = sinks.stored(rows, "observed").count()
    return spark.createDataFrame([*observed.get.items(), ("kept", kept)], "counted string, n long")


@query("SELECT event_id % 7 = 0 AS hidden, event_type AS channel, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS seqs FROM events WHERE event_id % 10 < 7 AND event_id % 7 <> 0 GROUP BY 1, 2")
def event_log_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log at several depths, parts of it in a hidden folder, by the reader that keeps what it can."""
    e = inputs.events(spark, sf_dir)
    line = F.when(F.col("seq") % 10 == 7, "{bad").when(F.col("seq") % 10 == 8, "[1]").otherwise(F.concat(F.lit('{"text": "'), F.col("seq").cast("string"), F.lit('"'), F.when(F.col("seq") % 10 == 9, "").otherwise(F.concat(F.lit(', "connector": "'), F.col("channel"), F.lit('", "ts": '), (F.col("us") / 1_000_000).cast("decimal(20,6)").cast("string"))), F.lit("}")))
    path = _folder(spark, "event-depths")
    for at, some in (("a", "seq % 7 = 1"), ("b/c", "seq % 7 > 1"), (".d", "seq % 7 = 0")):
        e.where(some).select(line.alias("value")).write.text(f"{path}/{at}")
    rows = readers.event_log(spark, path, recursive=True, pattern="*.txt")
    seq = F.col("text").cast("long")
    return rows.groupBy((seq % 7 == 0).alias("hidden"), "channel").agg(F.count("*").alias("n"), F.sum(seq).alias("seqs"))


@query("SELECT c_nationkey AS nation, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS position FROM customer")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One indented JSON array a file, read whole, a row for each member."""
    c = inputs.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sort_array(F.collect_list(F.struct("c_custkey"))).alias("all"))
    path = _folder(spark, "documents")
    c.select("c_nationkey", F.to_json("all", {"pretty": "true"}).alias("value")).repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    rows = readers.items(readers.documents(spark, path, pattern="*.txt", kind="ARRAY"))
    return rows.select(F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int").alias("nation"), F.try_variant_get("doc", "$.c_custkey", "bigint").alias("c_custkey"), F.col("position").cast("long").alias("position"))


@query(f"WITH {_EV} SELECT channel, strftime(make_timestamp(us) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d') AS local_day, count(*) AS n, sum(seq) AS seqs FROM ev GROUP BY 1, 2")
def shards_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log indexed in three batches, of which the first stops at a number of events and the last is replayed: shards hold
    each event once."""
    e = inputs.events(spark, sf_dir).select("us", "channel", "seq")
    shards, state = _folder(spark, "shards"), _folder(spark, "cursors")
    incremental.index_batch(e, shards, state, 0, default_us=0, limit=500)
    incremental.index_batch(e.where("us < 1705276800000000"), shards, state, 1, default_us=0)
    for _ in range(2):
        incremental.index_batch(e, shards, state, 2, default_us=0)
    rows = versions.read(spark, shards)
    return rows.groupBy("channel", F.col("local_day").cast("string").alias("local_day")).agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))


@query("SELECT o_orderkey, o_orderstatus, n FROM orders, (SELECT unnest([1, 2]) AS n)")
def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of JSON lines that two calls append to, read back."""
    rows, path = inputs.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey"), _folder(spark, "ledger")
    for n in (1, 2):
        sinks.sorted_json(rows.withColumn("n", F.lit(n)), path, mode="append")
    return spark.read.schema("n int, o_orderkey long, o_orderstatus string").json(path)


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line FROM documents")
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered text that is written in ranges and read back in the order of its files."""
    path = _folder(spark, "report")
    path = sinks.text_lines(inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("line")), "line", path, "doc_id")
    rows = readers.raw_lines(spark, path, "*.txt")
    sizes = rows.groupBy("name").agg(F.count("*").alias("n"))
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    base = sizes.select("name", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "name").select(F.col("value").cast("long").alias("doc_id"), (F.col("base") + F.col("line_no") - 1).alias("line"))


@query("SELECT c_custkey, c_acctbal, 2 AS made FROM customer WHERE c_acctbal < 1000")
def stale_result_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is written anew keeps nothing of what it held: the first version has all customers, the second others."""
    rows, path = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), _folder(spark, "stale")
    sinks.table(rows.withColumn("made", F.lit(1)), path)
    return sinks.table(rows.where("c_acctbal < 1000").withColumn("made", F.lit(2)), path)


@query("SELECT 'kept' AS found, c_custkey, c_acctbal FROM customer WHERE c_nationkey < 10 UNION ALL SELECT 'older' AS found, c_custkey, c_acctbal FROM customer")
def table_after_a_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writers of one table, of which the last fails half-way: the second version stays, and whoever reads the first
    one still does."""
    rows, path = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), _folder(spark, "failed")
    first = sinks.table(rows, path)
    sinks.table(rows.where("c_nationkey < 10"), path)
    broken = F.when(F.col("c_custkey") % 97 == 3, F.raise_error("half-way").cast("double")).otherwise(F.col("c_acctbal"))
    try:
        sinks.table(rows.withColumn("c_acctbal", broken), path)
    except PySparkException:
        pass
    else:
        raise AssertionError("the third writer should have failed")
    found = lambda df, name: df.select(F.lit(name).alias("found"), "c_custkey", "c_acctbal")
    return found(versions.read(spark, path), "kept").unionByName(found(first, "older"))


@query(f"WITH {_EV} SELECT channel, strftime(make_timestamp(us) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d') AS local_day, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs, 1 AS folders FROM ev GROUP BY 1, 2")
def shards_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches of the log, brought together in one part; then one of them is replayed, which changes nothing."""
    e = inputs.events(spark, sf_dir).select("us", "channel", "seq")
    shards, state = _folder(spark, "shards"), _folder(spark, "cursors")
    upto = [e.where(F.col("us") < 1_704_067_200_000_000 + (k + 1) * 8 * 86_400_000_000) for k in range(3)] + [e]
    for k, rows in enumerate(upto):
        incremental.index_batch(rows, shards, state, k, default_us=0)
    incremental.compact(spark, shards)
    incremental.index_batch(upto[2], shards, state, 2, default_us=0)
    rows = versions.read(spark, shards).groupBy("channel", F.col("local_day").cast("string").alias("local_day")).agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"))
    return rows.withColumn("folders", F.lit(len(versions.folders(spark, shards))))


# Ingestion

@query("""WITH o AS (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS d, strftime(o_orderdate, '%Y-%m-%d') || '_' || o_orderkey || '.md' AS file FROM orders)
SELECT file, epoch_us((d + INTERVAL '23:50:00' HOUR TO SECOND) AT TIME ZONE 'America/Los_Angeles') AS us, 1200.0::DOUBLE AS duration_s, 'hello ' || o_orderkey || ' plain' AS text, 1 AS timed, '23:50:00' AS start, '00:10:00' AS until FROM o
UNION ALL SELECT file, epoch_us((d + INTERVAL 1 DAY + INTERVAL '10:30' MINUTE TO SECOND) AT TIME ZONE 'America/Los_Angeles'), 90.0, 'next', 1, '00:10:30', '00:12:00' FROM o
UNION ALL SELECT file, epoch_us((d + INTERVAL 1 DAY + INTERVAL '12:00' MINUTE TO SECOND) AT TIME ZONE 'America/Los_Angeles'), 60.0, '', 0, '00:12:00', '00:13:00' FROM o""".replace("INTERVAL '23:50:00' HOUR TO SECOND", "INTERVAL 85800 SECOND").replace("INTERVAL '10:30' MINUTE TO SECOND", "INTERVAL 630 SECOND").replace("INTERVAL '12:00' MINUTE TO SECOND", "INTERVAL 720 SECOND"))
def transcript_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transcript for each order: lines belong to the header before them, days and ends wrap at midnight."""
    o = inputs.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    lines = F.array(F.lit("before any header"), F.lit("## 23:50:00 – 00:10:00"), F.concat(F.lit("[00:05] hello "), key), F.lit(""), F.lit("plain"), F.lit("## 00:10:30 - 00:12:00"), F.lit("[01:02:500] next"), F.lit("## 00:12:00 — 00:13:00"))
    rows = o.select(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"), key, F.lit(".md")).alias("name"), F.posexplode(lines).alias("line_no", "value"))
    made = ingest.chunks(rows)
    return made.select(F.col("source.file").alias("file"), "us", F.col("source.duration_s").alias("duration_s"), "text", F.size("source.lines").alias("timed"), F.col("source.chunk_start_local").alias("start"), F.col("source.chunk_end_local").alias("until"))


_SIX = "CASE seq % 6 WHEN 0 THEN 'audio' WHEN 1 THEN 'screen' WHEN 2 THEN 'filesys' WHEN 3 THEN 'calendar' WHEN 4 THEN 'notifications' ELSE 'email' END"
_RANK = "CASE channel WHEN 'screen' THEN 1 WHEN 'calendar' THEN 2 WHEN 'email' THEN 3 WHEN 'notifications' THEN 4 WHEN 'filesys' THEN 5 ELSE 6 END"


def _six(e: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(c) for c in ("audio", "screen", "filesys", "calendar", "notifications", "email")))
    return e.withColumn("channel", F.element_at(names, (F.col("seq") % 6 + 1).cast("int")))


@query(f"WITH {_EV}, s AS (SELECT seq, us - us % 3600000000 AS us, {_SIX} AS channel FROM ev) SELECT seq, channel, row_number() OVER (ORDER BY us, {_RANK}, seq) AS position FROM s")
def merged_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six channels whose events share their hours: ties go by the channels' order."""
    e = _six(inputs.events(spark, sf_dir)).select((F.col("us") - F.col("us") % 3_600_000_000).alias("us"), "channel", "seq")
    streams = [e.where(F.col("channel") == c) for c in reversed(ingest.CHANNELS)]
    return ingest.merged_positions(*streams, ties=("seq",)).select("seq", "channel", "position")


@query(f"""WITH {_EV}, s AS (SELECT seq, us, {_SIX} AS channel FROM ev)
SELECT seq, channel, CASE channel WHEN 'screen' THEN '{{"k":' || seq || ',"screenshot_path":"screenshots/c' || seq || '.png","start_time_local":"s"}}'
  WHEN 'email' THEN '{{"date":"' || strftime(make_timestamp(us - us % 1000000) - INTERVAL 7 HOUR, '%a, %-d %b %Y %H:%M:%S') || ' -0700","date_utc_iso":"' || strftime(make_timestamp(us), '%Y-%m-%dT%H:%M:%SZ') || '"}}'
  WHEN 'notifications' THEN '{{"timestamp":' || (seq + 978307200) || '}}' ELSE '{{"k":' || seq || '}}' END AS source FROM s""")
def payloads_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of six channels, each through its own normaliser."""
    e = _six(inputs.events(spark, sf_dir))
    k = F.col("seq").cast("string")
    sent = F.date_format(time.wall(F.col("us") - F.col("us") % 1_000_000 - 25_200_000_000), "EEE, d MMM yyyy HH:mm:ss")
    raw = {
        "screen": F.concat(F.lit('{"start_time":"s","raw_events":[1],"screenshot_path":"/a/b/c'), k, F.lit('.png","k":'), k, F.lit("}")),
        "email": F.concat(F.lit('{"date":"'), sent, F.lit(' -0700"}')),
        "notifications": F.concat(F.lit('{"timestamp":'), k, F.lit("}")),
    }
    made = []
    for c in ingest.CHANNELS:
        rows = e.where(F.col("channel") == c).select("us", k.alias("text"), F.parse_json(raw.get(c, F.concat(F.lit('{"k":'), k, F.lit("}")))).alias("source"))
        made.append(ingest.normalised(rows, c).select(F.col("text").cast("long").alias("seq"), "channel", _by_key(F.col("source")).alias("source")))
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out


def _by_key(fields: Column) -> Column:
    """A map of variants as JSON, keys sorted."""
    keys = F.sort_array(F.map_keys(fields))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(F.lit('"'), k, F.lit('":'), F.to_json(fields[k]))), ","), F.lit("}"))


@query(f"WITH {_EV} SELECT seq FROM ev WHERE us + 70000000000000 >= 1775458800000000")
def default_cutover(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.events(spark, sf_dir).withColumn("us", F.col("us") + 70_000_000_000_000)
    return ingest.since(e).select("seq")


@query(f"WITH {_EV} SELECT channel, count(*) AS n FROM (SELECT *, row_number() OVER (ORDER BY us, channel, seq) AS r FROM ev) WHERE r <= 700 GROUP BY 1")
def capped_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that takes the first events in time only."""
    shards, state = _folder(spark, "shards"), _folder(spark, "cursors")
    incremental.index_batch(inputs.events(spark, sf_dir).select("us", "channel", "seq"), shards, state, 0, default_us=0, limit=700)
    return versions.read(spark, shards).groupBy("channel").agg(F.count("*").alias("n"))


@query(f"""WITH {_EV}
SELECT channel, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs, 'shards' AS found FROM ev WHERE channel <> 'view' OR seq % 11 <> 0 GROUP BY 1
UNION ALL SELECT channel, count(*), CAST(sum(seq) AS BIGINT), 'late' FROM ev WHERE channel = 'view' AND seq % 11 = 0 AND us < 1705795200000000 GROUP BY 1""")
def tailed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel logs that grow by files between three triggers of a stream, which is started anew each time; some rows of one
    channel come two files late. The cursors are the stream's state.

    The second file of that channel goes on to later events than the rows that are held up, so its cursor is behind them
    all whichever row of the log comes last before they end."""
    e = inputs.events(spark, sf_dir).withColumn("file", F.when(F.col("us") < 1_704_931_200_000_000, 1).when(F.col("us") < 1_705_795_200_000_000, 2).otherwise(3))
    slow = F.col("channel") == "view"
    held_up = slow & (F.col("seq") % 11 == 0)
    longer = slow & (F.col("us") >= 1_705_795_200_000_000) & (F.col("us") < 1_706_140_800_000_000)
    e = e.where(~held_up | (F.col("us") < 1_705_795_200_000_000)).withColumn("file", F.when(held_up, 3).when(longer, 2).otherwise(F.col("file")))
    line = F.concat(F.lit('{"text": "'), F.col("seq").cast("string"), F.lit('", "timestamp": '), (F.col("us") / 1_000_000).cast("decimal(20,6)").cast("string"), F.lit("}"))
    rows = sinks.stored(e.select(F.col("channel").alias("folder"), "file", "us", "seq", line.alias("value")), "tailed")
    log, shards, late, checkpoint = (_folder(spark, n) for n in ("tail", "shards", "late", "state"))
    for k in (1, 2, 3):
        rows.where(F.col("file") == k).repartition("folder").sortWithinPartitions("folder", "us", "seq").select("folder", "value").write.mode("append").partitionBy("folder").text(log)
        tail.index(tail.channel_log(spark, log, pattern="*.txt", cutover_us=0), shards, late, checkpoint, 0).awaitTermination()
    out = None
    for found in ("shards", "late"):
        some = versions.read(spark, shards if found == "shards" else late).groupBy(F.regexp_replace("channel", "folder=", "").alias("channel")).agg(F.count("*").alias("n"), F.sum(F.col("text").cast("long")).alias("seqs")).withColumn("found", F.lit(found))
        out = some if out is None else out.unionByName(some)
    return out


@query(f"""WITH {_EV}, t AS (SELECT channel, seq, us - us % 86400000000 AS us FROM ev), c AS (SELECT channel, max(us) AS us FROM t WHERE seq % 2 = 0 AND us < 1705276800000000 GROUP BY 1),
m AS (SELECT t.channel, t.us, max(seq) AS seq FROM t JOIN c ON t.channel = c.channel AND t.us = c.us WHERE seq % 2 = 0 GROUP BY 1, 2)
SELECT t.channel, t.seq, t.us FROM t JOIN m ON t.channel = m.channel WHERE t.us > m.us OR (t.us = m.us AND t.seq > m.seq)""")
def cursor_among_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is new behind a cursor that stops among many events of one instant: none of those behind it is lost."""
    e = inputs.events(spark, sf_dir).select("channel", "seq", (F.col("us") - F.col("us") % 86_400_000_000).alias("us"))
    seen = incremental.cursors(e.where("seq % 2 = 0 AND us < 1705276800000000"))
    return incremental.split(e, seen)[0].select("channel", "seq", "us")


@query(f"""WITH {_EV}, b AS (SELECT min(us) AS lo, max(us) AS hi, greatest(1, CAST(ceil((max(us) - min(us)) / 900000000.0) AS BIGINT)) AS n FROM ev),
k AS (SELECT channel, least((us - lo) // 900000000, n - 1) AS bucket FROM ev, b)
SELECT dense_rank() OVER (ORDER BY bucket) - 1 AS interval_index, channel, n FROM (SELECT bucket, channel, count(*) AS n FROM k GROUP BY 1, 2)""")
def interval_channel_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts by channel that each interval of the activity holds as a map."""
    rows = intervals.activity(inputs.events(spark, sf_dir))
    return rows.select("interval_index", F.explode("channel_counts").alias("channel", "n"))


_CENTERS = (1_703_000_000_000_000, 1_704_070_000_000_000, 1_705_312_800_000_000, 1_706_572_800_000_000, 1_800_000_000_000_000)


@query(f"""WITH {_EV}, c AS (SELECT unnest([{", ".join(map(str, _CENTERS))}]) AS center),
p AS (SELECT center, 'past' AS side, seq, row_number() OVER (PARTITION BY center ORDER BY us DESC, seq DESC) AS r, count(*) OVER (PARTITION BY center) AS k FROM c JOIN ev ON us <= center),
f AS (SELECT center, 'future' AS side, seq, row_number() OVER (PARTITION BY center ORDER BY us, seq) AS r FROM c JOIN ev ON us > center)
SELECT x.*, (SELECT count(*) FROM ev WHERE us <= center) AS before_available, (SELECT count(*) FROM ev WHERE us > center) AS after_available
FROM (SELECT center, side, seq, least(k, 40) - r AS index FROM p WHERE r <= 40 UNION ALL SELECT center, side, seq, r - 1 FROM f WHERE r <= 30) x""")
def log_window_by_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbourhoods of a few instants in a log of three batches, before, in and after it, by the log's zone map."""
    e = inputs.events(spark, sf_dir).select("us", "channel", "seq")
    log, state, zones = (_folder(spark, n) for n in ("log", "cursors", "zones"))
    for k in range(2):
        incremental.index_batch(e.where(F.col("us") < 1_704_067_200_000_000 + (k + 1) * 12 * 86_400_000_000), log, state, k, default_us=0)
    api.log_window(spark, log, zones, _CENTERS[2])  # the zones of what there is so far
    incremental.index_batch(e, log, state, 2, default_us=0)
    out = None
    for center in _CENTERS:
        rows = api.log_window(spark, log, zones, center, 40, 30).select(F.lit(center).alias("center"), "side", "seq", "index", "before_available", "after_available")
        out = rows if out is None else out.unionByName(rows)
    return out


# Fallbacks

@query(f"""WITH {_EV} SELECT seq, CASE seq % 3 WHEN 0 THEN us + 5 WHEN 1 THEN us - us % 1000000 ELSE us - us % 1000000 + 1000000 END AS cutoff FROM ev""")
def interval_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end's number, else its text in UTC, else the local one."""
    e = inputs.events(spark, sf_dir)
    second = F.col("us") - F.col("us") % 1_000_000
    number = F.when(F.col("seq") % 3 == 0, F.col("us") + 5)
    utc = F.when(F.col("seq") % 3 <= 1, time.iso_short(second)).otherwise("")
    return e.select("seq", intervals.cutoff(number, utc, time.iso_local(second + 1_000_000)).alias("cutoff"))


@query(f"WITH {_EV} SELECT seq, CASE WHEN seq % 4 = 0 THEN us ELSE us - us % 1000000 END AS us FROM ev")
def backfilled_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.events(spark, sf_dir)
    stamp = F.concat(F.lit("at "), time.iso_short(F.col("us") - F.col("us") % 1_000_000))
    rows = e.select("seq", F.when(F.col("seq") % 4 == 0, F.col("us")).alias("us"), stamp.alias("stamp"))
    return readers.dated(rows, F.col("stamp")).select("seq", "us")


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 't' WHEN 1 THEN 's' WHEN 2 THEN 'a' WHEN 3 THEN 'e' WHEN 4 THEN 'g' ELSE 'id' || o_orderkey END AS title,
  CASE o_orderkey % 3 WHEN 0 THEN 'own' WHEN 1 THEN 'nested' END AS suggestion FROM orders""")
def opportunity_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs.table(spark, sf_dir, "orders")
    names = ("title", "suggestion", "action", "expected_artifact", "goal")
    cells = [F.when(F.col("o_orderkey") % 6 == i, n[0]).otherwise("" if i % 2 else None).alias(n) for i, n in enumerate(names)]
    rows = o.select("o_orderkey", *cells, F.concat(F.lit("id"), F.col("o_orderkey").cast("string")).alias("opportunity_id"))
    nested = F.struct(F.when(F.col("o_orderkey") % 3 < 2, "nested").alias("suggestion"))
    own = F.when(F.col("o_orderkey") % 3 == 0, "own").otherwise("")
    return rows.select("o_orderkey", opportunities.title().alias("title"), opportunities.suggestion(own, nested).alias("suggestion"))


@query("SELECT o_orderkey, 'for ' || o_orderpriority || ': {\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"} {kept}' AS prompt FROM orders")
def filled_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs.table(spark, sf_dir, "orders").withColumn("row", F.struct("o_orderkey", "o_orderstatus"))
    text = generate.template("for {priority}: {row} {kept}", ("priority", "row"))
    return generate.prompts(o, text, priority="o_orderpriority", row="row").select("o_orderkey", "prompt")


@query("SELECT o_orderkey, CASE WHEN k = 'threaded' THEN 10 ELSE greatest(3, least(o_orderkey % 14, 10)) END AS pairs, k AS kind FROM orders, (SELECT unnest(['timing', 'threaded']) AS k)")
def pair_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = generate.work_items(inputs.table(spark, sf_dir, "orders").select("o_orderkey"), ["timing", "threaded"], "kind")
    return o.select("o_orderkey", "kind", validate.pair_budget(F.col("kind"), F.col("o_orderkey") % 14).alias("pairs"))


# Validators

def _context(size: Column, shifted: Column) -> Column:
    """size events whose indexes are their positions, but for the last where shifted."""
    every = F.when(size > 0, F.sequence(F.lit(0).cast("long"), size - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
    return F.transform(every, lambda i: F.struct((i + F.when(shifted & (i == size - 1), 1).otherwise(0)).alias("index"), F.lit(0.0).alias("ts"), F.lit("x").alias("ts_iso"), F.lit("screen").alias("channel"), F.lit("").alias("text"))).cast(f"array<{EVENT}>")


def _pairs(size: Column, broken: Column, first: int = 0) -> Column:
    """size complete pairs, the last of which lacks an answer where broken."""
    every = F.when(size > 0, F.sequence(F.lit(0).cast("long"), size.cast("long") - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
    basis = F.struct(F.array(F.lit(0).cast("long")).alias("context_event_indexes"), F.lit("because").alias("reason"))
    x = lambda s: F.lit(s)
    return F.transform(every, lambda i: F.struct((i + first).alias("q_id"), x("q").alias("question"), F.when(broken & (i == size - 1), "").otherwise("a").alias("answer"), x("c").alias("category"), x("short").alias("timescale"), x("H").alias("answer_basis"), F.lit(5).cast("long").alias("verify_us"), x("z").alias("verify_at_iso"), basis.alias("question_basis"), x("w").alias("why_it_matters"), x("e").alias("evidence_grounding"), F.lit(1.0).alias("question_difficulty"))).cast(f"array<{PAIR}>")


@query("SELECT o_orderkey, o_orderkey % 103 <= 100 AND NOT (o_orderkey % 3 = 0 AND o_orderkey % 103 > 0) AS ok FROM orders")
def context_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", validate.context_ok(_context(F.col("o_orderkey") % 103, F.col("o_orderkey") % 3 == 0)).alias("ok"))


_LISTED = "array_to_string(list_filter([{0}], lambda x: x IS NOT NULL), ',')"


@query("""SELECT o_orderkey, """ + _LISTED.format("""CASE WHEN o_orderkey % 7 = 0 THEN 'qa_type' END, CASE WHEN o_orderkey % 11 = 0 THEN 'cutoff' END, CASE WHEN o_orderkey % 3 = 0 THEN 'context' END,
  CASE WHEN NOT (o_orderkey % 12 BETWEEN CASE WHEN o_orderkey % 7 = 1 THEN 0 ELSE 3 END AND 10) THEN 'pair_count' END,
  CASE WHEN o_orderkey % 12 > 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 11 = 0) THEN 'pair' END""") + """ AS violations FROM orders""")
def interval_documents_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat documents of 0 to 11 pairs, some of an unknown type, without a cutoff, with a gap in the context or a pair that
    lacks its answer."""
    k = F.col("o_orderkey")
    kind = F.when(k % 7 == 0, "nope").when(k % 7 == 1, "verbatim_textbox").otherwise("todo")
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("qa_type"), F.when(k % 11 != 0, F.lit(5).cast("long")).alias("cutoff_us"), _context(F.lit(2).cast("long"), k % 3 == 0).alias("context"), F.lit(None).cast(f"array<{THREAD}>").alias("threads"), _pairs(k % 12, k % 5 == 0).alias("qa_pairs"))
    return validate.interval_documents(rows).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


_KINDS = ", ".join(f"'{t}'" for t in (*validate.INTERVAL_TYPES, "nope"))


@query(f"""SELECT o_orderkey, ([{_KINDS}])[o_orderkey % {len(validate.INTERVAL_TYPES) + 1} + 1] AS qa_type, """ + _LISTED.format(f"""CASE WHEN o_orderkey % {len(validate.INTERVAL_TYPES) + 1} = {len(validate.INTERVAL_TYPES)} THEN 'qa_type' END,
  CASE WHEN o_orderkey % 13 > 10 OR (o_orderkey % 13 < 3 AND o_orderkey % {len(validate.INTERVAL_TYPES) + 1} <> {validate.INTERVAL_TYPES.index(validate.SPARSE_TYPES[0])}) THEN 'pair_count' END""") + """ AS violations FROM orders""")
def interval_types_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of every type and of one that isn't known, of 0 to 12 pairs."""
    k, kinds = F.col("o_orderkey"), (*validate.INTERVAL_TYPES, "nope")
    kind = F.element_at(F.array(*(F.lit(t) for t in kinds)), (k % len(kinds) + 1).cast("int"))
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("qa_type"), F.lit(5).cast("long").alias("cutoff_us"), _context(F.lit(2).cast("long"), F.lit(False)).alias("context"), F.lit(None).cast(f"array<{THREAD}>").alias("threads"), _pairs(k % 13, F.lit(False)).alias("qa_pairs"))
    return validate.interval_documents(rows).select("o_orderkey", "qa_type", F.array_join("violations", ",").alias("violations"))


_SEEDS = ", ".join(f"'{t}'" for t in (*validate.SEED_TYPES, "nope"))


@query(f"""WITH d AS (SELECT o_orderkey, ([{_SEEDS}])[o_orderkey % {len(validate.SEED_TYPES) + 1} + 1] AS qa_type FROM orders)
SELECT o_orderkey, qa_type, """ + _LISTED.format("""CASE WHEN qa_type = 'nope' THEN 'qa_type' END, CASE WHEN CASE WHEN qa_type = 'threaded' THEN o_orderkey % 3 <> 1 ELSE NOT (o_orderkey % 13 BETWEEN 3 AND 10) END THEN 'pair_count' END,
  CASE WHEN o_orderkey % 4 = 0 AND (qa_type = 'threaded' OR o_orderkey % 13 > 0) THEN 'pair' END""") + """ AS violations FROM d""")
def seed_types_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of every type and of an unknown one: flat ones of 0 to 12 pairs, threaded ones of two to four threads of three."""
    k, kinds = F.col("o_orderkey"), (*validate.SEED_TYPES, "nope")
    kind = F.element_at(F.array(*(F.lit(t) for t in kinds)), (k % len(kinds) + 1).cast("int"))
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", kind.alias("qa_type"), F.lit(5).cast("long").alias("cutoff_us"), _context(F.lit(2).cast("long"), F.lit(False)).alias("context"), _threads(k % 3 + 2, F.lit(3), F.lit(False), k % 4 == 0).alias("threads"), _pairs(k % 13, k % 4 == 0).alias("qa_pairs"))
    return validate.seed_documents(rows).select("o_orderkey", "qa_type", F.array_join("violations", ",").alias("violations"))


def _threads(count: Column, size: Column, shifted: Column, broken: Column) -> Column:
    """count threads of size pairs, the last numbered one too high where shifted."""
    every = F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)
    own = _pairs(size, broken)
    return F.transform(every, lambda i: F.struct((i + F.when(shifted & (i == count - 1), 1).otherwise(0)).alias("thread_id"), own.alias("qa_pairs"))).cast(f"array<{THREAD}>")


@query("""SELECT o_orderkey, """ + _LISTED.format("""CASE WHEN NOT (o_orderkey % 4 + 1 = 3 AND o_orderkey % 5 + 1 = 3 AND o_orderkey % 7 <> 0) THEN 'pair_count' END, CASE WHEN o_orderkey % 9 = 0 THEN 'pair' END""") + """ AS violations FROM orders""")
def seed_documents_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threaded documents: right are three threads, numbered from 0, of nine or ten pairs in all."""
    k = F.col("o_orderkey")
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.lit("threaded").alias("qa_type"), F.lit(5).cast("long").alias("cutoff_us"), _context(F.lit(2).cast("long"), F.lit(False)).alias("context"), _threads(k % 4 + 1, k % 5 + 1, k % 7 == 0, k % 9 == 0).alias("threads"), F.lit(None).cast(f"array<{PAIR}>").alias("qa_pairs"))
    return validate.seed_documents(rows).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query("""SELECT o_orderkey, """ + _LISTED.format("""CASE WHEN NOT (o_orderkey % 4 + 1 = 3 AND o_orderkey % 13 BETWEEN 3 AND 10 AND o_orderkey % 7 <> 0) THEN 'threads' END, CASE WHEN o_orderkey % 9 = 0 AND o_orderkey % 13 > 0 THEN 'pair' END""") + """ AS violations FROM orders""")
def question_documents_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = inputs.table(spark, sf_dir, "orders").select("o_orderkey", _context(F.lit(2).cast("long"), F.lit(False)).alias("context"), _threads(k % 4 + 1, k % 13, k % 7 == 0, k % 9 == 0).alias("threads"), F.lit(None).cast(f"array<{PAIR}>").alias("qa_pairs"))
    return validate.question_documents(rows).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query("SELECT o_custkey, CASE WHEN count(*) >= 2 THEN '' ELSE 'members' END AS violations FROM orders GROUP BY 1")
def link_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("members"))  # a customer's orders
    return validate.enough_members(rows).select("o_custkey", F.array_join("violations", ",").alias("violations"))


@query("SELECT doc_id, " + _LISTED.format("CASE WHEN coalesce(text, '') = '' THEN 'text' END, CASE WHEN coalesce(source, '') = '' THEN 'source' END, CASE WHEN lang = 'en' THEN 'lang' END") + " AS missing FROM documents")
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = inputs.table(spark, sf_dir, "documents").withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")))
    return d.select("doc_id", F.array_join(themes.missing_fields(d, "text", "source", "lang"), ",").alias("missing"))


@query("SELECT event_id, event_id % 3 = 0 AS is_list, event_id % 3 = 1 AS is_object FROM events")
def variant_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.parse_json(F.when(F.col("event_id") % 3 == 0, "[1, 2]").when(F.col("event_id") % 3 == 1, F.col("props")).otherwise("3"))
    rows = inputs.table(spark, sf_dir, "events").select("event_id", doc.alias("doc"))
    return rows.select("event_id", validate.variant_is(F.col("doc"), "ARRAY").alias("is_list"), validate.variant_is(F.col("doc"), "OBJECT").alias("is_object"))


# Documents

_Q = """t AS (SELECT conv_id, turn, text, role, lead(text) OVER w AS answer, lead(role) OVER w AS answers FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS q_id, text AS question FROM t WHERE role = 'user' AND answers = 'assistant')"""
_TYPE = "CASE WHEN conv_id % 5 <> 0 THEN 'type' || (conv_id % 3) END"


@query(f"WITH {_Q} SELECT CAST(conv_id AS VARCHAR) AS doc_key, q_id, CASE WHEN q_id % 2 = 0 THEN 'even' ELSE 'p/' || {_TYPE} END AS category FROM q")
def default_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pairs.attached(inputs.documents(spark, sf_dir), "p/")
    return rows.select("doc_key", F.explode(pairs.all_pairs(F.col("qa_pairs"), F.col("threads"))).alias("p")).select("doc_key", "p.q_id", "p.category")


@query(f"""WITH {_Q}, d AS (SELECT conv_id, count(*) AS n, {_TYPE} AS qa_type FROM q GROUP BY 1)
SELECT row_number() OVER (ORDER BY conv_id * 1000000 NULLS LAST, qa_type NULLS FIRST, CAST(conv_id AS VARCHAR)) AS position, CAST(conv_id AS VARCHAR) AS doc_key, qa_type, n AS pair_count FROM d WHERE qa_type IS NOT NULL""")
def document_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by instant, type and key, with the number of their pairs."""
    from chronolith.operators.order import numbered

    rows = api.document_list(inputs.documents(spark, sf_dir).where("qa_type IS NOT NULL"))
    return numbered(rows, "position", F.col("cutoff_us").asc_nulls_last(), "qa_type", "doc_key").select("position", "doc_key", "qa_type", "pair_count")


@query(f"WITH {_Q} SELECT DISTINCT CAST(conv_id AS VARCHAR) AS doc_key FROM q WHERE {_TYPE} = 'type1' AND conv_id = 1")
def document_of_a_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.document(inputs.documents(spark, sf_dir), "type1", "1").select("doc_key")


@query("""WITH b AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT o_custkey AS input_index, n AS goals FROM b WHERE o_custkey % 2 = 0
UNION ALL SELECT o_custkey, n FROM b WHERE o_custkey % 2 = 1""")
def both_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of two items and files of one as one table of items."""
    opportunity = opportunities.OPPORTUNITY
    goal = F.transform("ks", lambda k: F.struct(k.cast("string").alias("goal"), F.expr(f"cast(array() as array<{opportunity}>)").alias("opportunities")))
    rows = inputs.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("input_index")).agg(F.collect_list("o_orderkey").alias("ks")).select("input_index", goal.alias("goals"))
    batches = rows.where("input_index % 2 = 0").groupBy(F.expr("input_index div 4").alias("b")).agg(F.collect_list(F.struct("input_index", "goals")).alias("items"))
    out = opportunities.both_layouts(batches, rows.where("input_index % 2 = 1"))
    return out.select(F.explode("items").alias("i")).select("i.input_index", F.size("i.goals").cast("long").alias("goals"))


@query(f"WITH {_Q} SELECT CAST(conv_id AS VARCHAR) AS doc_key, 1000000 - conv_id AS position FROM q WHERE conv_id IN (SELECT doc_id FROM labels) GROUP BY conv_id")
def selection_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = inputs.documents(spark, sf_dir)
    wanted = inputs.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_key"), (1_000_000 - F.col("doc_id")).alias("position")).distinct()
    return pairs.in_selection_order(d, wanted).select("doc_key", "position")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS status FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second normalisation would have to write again: rows that differ and rows that are new."""
    o = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    after = o.withColumn("status", F.when(F.col("o_orderkey") % 3 == 0, "new").otherwise(F.col("status")))
    return pairs.changed(o.where("o_orderkey % 5 <> 0"), after, "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 0 THEN 'new' ELSE o_orderstatus END AS status, o_totalprice FROM orders WHERE o_orderkey % 997 = 0 OR o_orderkey % 1999 = 5")
def changed_rows_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few rows that differ and a few that are new, found by the digests of ranges; those of the older table were kept."""
    o = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    after = o.withColumn("status", F.when(F.col("o_orderkey") % 997 == 0, "new").otherwise(F.col("status")))
    before = o.where("o_orderkey % 1999 <> 5")
    return digests.changed(before, after, "o_orderkey", known=sinks.stored(digests.leaves(before, "o_orderkey"), "leaves"))


@query("""SELECT CAST(o_custkey AS VARCHAR) AS run, o_orderkey FROM orders o WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderstatus = 'O'))""")
def first_existing_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's rows in the new layout, else those in the old one."""
    o = inputs.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("run"), "o_orderkey", "o_orderstatus")
    return api.first_existing(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'")).select("run", "o_orderkey")


@query("SELECT doc_id, regexp_matches(s, '^(global|(days|intervals)_[A-Za-z0-9_-]+)$') AS is_scope, regexp_matches(t, '^[a-z][a-z0-9_]*$') AS is_type FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'global' WHEN 1 THEN 'days_' || doc_id WHEN 2 THEN 'days_' ELSE '../' || doc_id END AS s, CASE doc_id % 3 WHEN 0 THEN 'todo_1' WHEN 1 THEN 'Todo' ELSE '1x' END AS t FROM documents)")
def api_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    s = F.when(k % 4 == 0, "global").when(k % 4 == 1, F.concat(F.lit("days_"), k.cast("string"))).when(k % 4 == 2, "days_").otherwise(F.concat(F.lit("../"), k.cast("string")))
    t = F.when(k % 3 == 0, "todo_1").when(k % 3 == 1, "Todo").otherwise("1x")
    return inputs.table(spark, sf_dir, "documents").select("doc_id", s.rlike(api.SCOPE.pattern).alias("is_scope"), t.rlike(api.TYPE.pattern).alias("is_type"))


@query("""WITH s AS (SELECT count(*) AS n, sum(length('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}')) AS c FROM nation) SELECT 'ok' AS status, CAST(length('Rank: ') + c + n + 1 AS BIGINT) AS asked FROM s""")
def ranked_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call for a whole set; the stand-in says how much it was asked."""
    rows = inputs.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = generate.ranked_at_once(rows, generate.stub, "Rank: {rows}", "n_nationkey")
    return out.select("status", F.regexp_extract("output", "of ([0-9]+) characters", 1).cast("long").alias("asked"))


# Calls

def _refusing(prompt: str) -> str:
    """A stand-in that refuses one prompt in ten."""
    if prompt.endswith("7"):
        raise ValueError(f"refused {prompt}")
    return prompt.upper()


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("prompt"))
    return generate.run(o, _refusing)


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 7 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 10 = 7 THEN 'ValueError: refused order ' || o_orderkey END AS error,
  CASE WHEN o_orderkey % 10 <> 7 THEN length('order ' || o_orderkey) END AS output_chars FROM orders""")
def call_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of each call, appended as JSON lines and read back."""
    path = _folder(spark, "calls")
    sinks.sorted_json(generate.ledger(sinks.stored(_calls(spark, sf_dir)), "o_orderkey"), path, mode="append")
    return spark.read.schema("o_orderkey long, status string, error string, output_chars long").json(path)


@query("SELECT o_orderkey, 'ORDER ' || o_orderkey AS output FROM orders WHERE o_orderkey % 10 <> 7")
def published_despite_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.published(_calls(spark, sf_dir), keep_going=True).select("o_orderkey", "output")


@query("""SELECT o_custkey, '{"ROWS":[' || string_agg('{"O_ORDERKEY":' || o_orderkey || '}', ',' ORDER BY o_orderkey) || ']} OK' AS output, 'ok' AS status FROM orders GROUP BY 1""")
def combined_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call for all rows of an owner: many rows become one result."""
    o = inputs.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return generate.run_batches(o, _refusing, '{"rows":{rows}} ok', "o_custkey", "o_orderkey").select("o_custkey", "output", "status")


@query("SELECT o_orderkey, substr('order ' || o_orderkey, 1, 8) AS prompt FROM orders")
def previewed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What would be asked, without a call."""
    o = inputs.table(spark, sf_dir, "orders")
    return generate.preview(generate.prompts(o, "order {k}", k="o_orderkey"), size=8).select("o_orderkey", "prompt")


def _failing(prompt: str) -> str:
    if prompt.endswith("42"):
        raise ValueError("not yet")
    return prompt.upper()


@query("SELECT c_custkey, 'CUSTOMER ' || c_custkey AS output, 1 AS calls FROM customer")
def calls_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that stop at a failure, and go on in a second try: each row has one result, and one call that gave it."""
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("prompt"))
    path, size = _folder(spark, "resumed"), max(1, rows.count() // 8)
    try:
        generate.resumed(rows, _failing, path, "c_custkey", chunk=size)
    except RuntimeError:
        pass
    out = generate.resumed(rows, str.upper, path, "c_custkey", chunk=size)
    return out.groupBy("c_custkey", "output").agg(F.count("*").cast("int").alias("calls"))


def _linking(prompt: str) -> str:
    """Links each theme with the next one; of an owner with five themes or more also the first with one that isn't there, and
    one with itself."""
    keys = [t["o_orderkey"] for t in json.loads(prompt.split("\n", 1)[1])]
    found = [{"members": [a, b], "name": f"{a} to {b}"} for a, b in zip(keys, keys[1:], strict=False)]
    if len(keys) >= 5:
        found += [{"members": [keys[0], -1], "name": "odd"}, {"members": [keys[1], keys[1]], "name": "self"}, {"members": [keys[2]], "name": "one"}]
    return json.dumps({"links": found})


@query("""WITH o AS (SELECT o_custkey, o_orderkey, row_number() OVER w - 1 AS p, lead(o_orderkey) OVER w AS nxt, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_custkey, p AS position, o_orderkey || ',' || nxt AS members, o_orderkey || ' to ' || nxt AS name, '' AS violations FROM o WHERE nxt IS NOT NULL
UNION ALL SELECT o_custkey, n - 1, o_orderkey || ',-1', 'odd', 'unknown' FROM o WHERE p = 0 AND n >= 5
UNION ALL SELECT o_custkey, n, o_orderkey || ',' || o_orderkey, 'self', 'repeated' FROM o WHERE p = 1 AND n >= 5
UNION ALL SELECT o_custkey, n + 1, CAST(o_orderkey AS VARCHAR), 'one', 'members' FROM o WHERE p = 2 AND n >= 5""")
def links_of_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links among each owner's themes by one call, with what is wrong with them."""
    o = inputs.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"))
    rows = generate.links(o, _linking, "Link these:\n{rows}", "o_custkey", "o_orderkey")
    return rows.select("o_custkey", "position", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"), "name", F.array_join("violations", ",").alias("violations"))


@query("""WITH k AS (SELECT p_partkey, unnest(['timing', 'value']) AS qa_type FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0),
s AS (SELECT p_partkey, qa_type, length(CASE qa_type WHEN 'timing' THEN 'When? Seed ' ELSE 'What for? Seed ' END || p_partkey || '.') AS n FROM k WHERE NOT (qa_type = 'value' AND p_partkey % 5 = 0))
SELECT p_partkey, qa_type, i AS q_id, 'Question ' || i || ' of ' || n || ' characters?' AS question, 'Answer ' || (n + i) || '.' AS answer FROM s, (SELECT unnest([0, 1, 2]) AS i)""")
def seed_pairs_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds with every type as work, less what has a result already, each by its type's template: three pairs a call."""
    seeds = inputs.table(spark, sf_dir, "part").where("p_partkey % 3 <> 0 OR p_partkey % 2 = 0").select("p_partkey")
    work = generate.work_items(seeds, ["timing", "value"])
    work = generate.todo(work, work.where("qa_type = 'value' AND p_partkey % 5 = 0"), "p_partkey", "qa_type")
    asked = None
    for kind, text in (("timing", "When? Seed {k}."), ("value", "What for? Seed {k}.")):
        some = generate.prompts(work.where(F.col("qa_type") == kind), text, k="p_partkey")
        asked = some if asked is None else asked.unionByName(some)
    done = generate.published(generate.run(asked, generate.stub))
    pairs_ = F.from_json("output", "struct<qa_pairs: array<struct<q_id: bigint, question: string, answer: string>>>")["qa_pairs"]
    return done.select("p_partkey", "qa_type", F.explode(pairs_).alias("p")).select("p_partkey", "qa_type", "p.*")
