"""Every query of the engine by name, with the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.functions import text as words
from chronolith.functions import time
from chronolith.operators import api, asof, generate, ingest, intervals, opportunities, pairs, ranking, sampling, themes, validate
from chronolith.operators.order import positions
from chronolith.plans import inputs
from chronolith.plans.registered import oracle_sql, queries, query
from chronolith.streaming import incremental

__all__ = ["oracle_sql", "queries"]

WIDTH = 900_000_000
_EV = "ev AS (SELECT epoch_us(ts) AS us, event_type AS channel, event_id AS seq, props, user_id, value FROM events)"
_BK = f"b AS (SELECT min(us) AS lo, max(us) AS hi, greatest(1, CAST(ceil((max(us) - min(us)) / {WIDTH}.0) AS BIGINT)) AS n FROM ev), k AS (SELECT ev.*, lo, hi, least((us - lo) // {WIDTH}, n - 1) AS bucket FROM ev, b)"
_LOCAL = "(make_timestamp({0}) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles')"
_OFF = "(epoch_us(" + _LOCAL + ") - ({0})) // 60000000"


def _local_iso(us: str) -> str:
    m = _OFF.format(us)
    return f"strftime({_LOCAL.format(us)}, '%Y-%m-%dT%H:%M:%S.%g') || CASE WHEN {m} < 0 THEN '-' ELSE '+' END || lpad(CAST(abs({m}) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(abs({m}) % 60 AS VARCHAR), 2, '0')"


def _utc_iso(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S.%gZ')"


# Intervals

_INTERVALS = f"""iv AS (
  SELECT dense_rank() OVER (ORDER BY bucket) - 1 AS interval_index, lo + bucket * {WIDTH} AS start_us, least(lo + (bucket + 1) * {WIDTH}, hi) AS end_us, count(*) AS event_count
  FROM k GROUP BY bucket, lo, hi)"""


@query(f"""WITH {_EV}, {_BK}, {_INTERVALS}
SELECT interval_index, start_us, end_us, {_utc_iso('start_us')} AS start_utc, {_utc_iso('end_us')} AS end_utc, {_local_iso('start_us')} AS start_local,
  {_local_iso('end_us')} AS end_local, (end_us - start_us) / 1000000.0::DOUBLE AS duration_seconds, event_count FROM iv""")
def interval_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.activity(inputs.events(spark, sf_dir)).drop("channel_counts")


@query(f"""WITH {_EV}, {_BK}, c AS (SELECT bucket, count(*) AS c FROM k GROUP BY 1)
SELECT i AS interval_index, lo + i * {WIDTH} AS start_us, least(lo + (i + 1) * {WIDTH}, hi) AS end_us, coalesce(c, 0) AS event_count
FROM (SELECT lo, hi, unnest(range(0, n)) AS i FROM b) LEFT JOIN c ON bucket = i""")
def interval_activity_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.activity(inputs.events(spark, sf_dir), include_empty=True).select("interval_index", "start_us", "end_us", "event_count")


@query(f"WITH {_EV}, {_BK} SELECT bucket, channel, count(*) AS event_count FROM k GROUP BY 1, 2")
def interval_channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.channel_counts(inputs.events(spark, sf_dir))


@query(f"""WITH {_EV}, {_BK}, {_INTERVALS}, d AS (
  SELECT strftime({_LOCAL.format('start_us')}, '%Y-%m-%d') AS day, count(*) AS intervals, min(interval_index) AS first_index, max(interval_index) AS last_index FROM iv GROUP BY 1)
SELECT row_number() OVER (ORDER BY first_index) - 1 AS day_index, *, CASE WHEN first_index = last_index THEN CAST(first_index AS VARCHAR) ELSE first_index || '-' || last_index END AS label FROM d""")
def interval_day_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.by_day(intervals.activity(inputs.events(spark, sf_dir)))


@query(f"WITH {_EV}, {_BK}, {_INTERVALS} SELECT interval_index, event_count FROM iv WHERE interval_index BETWEEN 100 AND 900 ORDER BY 1 LIMIT 50 OFFSET 20")
def range_offset_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.activity(inputs.events(spark, sf_dir)).select("interval_index", "event_count")
    return intervals.selected(rows, "100-900", 20, 50)


@query(f"WITH {_EV}, {_BK}, {_INTERVALS} SELECT interval_index, event_count FROM iv WHERE interval_index IN (0, 3) OR interval_index BETWEEN 10 AND 12")
def index_list_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals.activity(inputs.events(spark, sf_dir)).select("interval_index", "event_count")
    return rows.where(intervals.in_ranges("interval_index", intervals.parse_list("0,3,10-12")))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.duplicate_indexes(inputs.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


# Instants

@query(f"WITH {_EV} SELECT seq, us, {_utc_iso('us')} AS iso FROM ev")
def epoch_to_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).select("seq", "us", time.iso_millis(F.col("us")).alias("iso"))


@query(f"WITH {_EV} SELECT seq, {_local_iso('us')} AS iso FROM ev")
def epoch_to_local_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).select("seq", time.iso_local(F.col("us")).alias("iso"))


@query("""SELECT o_orderkey, (epoch_us(o_orderdate AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles') - epoch_us(o_orderdate)) // 1000000 AS seconds FROM orders""")
def tz_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", time.offset_seconds(time.micros(F.col("o_orderdate"))).cast("long").alias("seconds"))


@query(f"WITH {_EV} SELECT channel, strftime({_LOCAL.format('us')}, '%Y-%m-%d') AS local_day, count(*) AS events, min(us) AS first_us, max(us) AS last_us FROM ev GROUP BY 1, 2")
def day_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).withColumn("local_day", time.local_day(F.col("us")))
    return rows.groupBy("channel", "local_day").agg(F.count("*").alias("events"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))


@query("""SELECT o_orderkey, CASE WHEN h > 0 THEN h || 'h' || lpad(CAST(m AS VARCHAR), 2, '0') || 'm' || lpad(CAST(s AS VARCHAR), 2, '0') || 's'
  WHEN m > 0 THEN m || 'm' || lpad(CAST(s AS VARCHAR), 2, '0') || 's' ELSE s || 's' END AS label
FROM (SELECT o_orderkey, t // 3600 AS h, t % 3600 // 60 AS m, t % 60 AS s FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 9000 AS t FROM orders))""")
def duration_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders")
    return rows.select("o_orderkey", time.duration_label(F.floor("o_totalprice").cast("long") % 9000).alias("label"))


@query("SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles', '%a %b %-d, %-I:%M %p') AS label FROM events")
def human_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).select(F.col("seq").alias("event_id"), time.label(F.col("us")).alias("label"))


@query("""SELECT event_id, epoch_us(ts) AS from_iso, epoch_us(ts) + 60000000 AS from_window, epoch_us(ts) AS from_text, CAST(NULL AS BIGINT) AS from_noise FROM events""")
def parse_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.events(spark, sf_dir)
    iso, later = time.iso_short(F.col("us")), time.iso_short(F.col("us") + 60_000_000)
    none = F.lit(None).cast("double")
    return e.select(F.col("seq").alias("event_id"), time.parse_event(none, iso).alias("from_iso"), time.parse_window_end(none, F.concat_ws("/", iso, later)).alias("from_window"), time.parse_first(F.concat_ws(" ", F.lit("at"), iso, F.lit("or so"), later)).alias("from_text"), time.parse_event(none, F.lit("16:31")).alias("from_noise"))


# As-of joins

_CTX = f"""WITH {_EV}, a AS (SELECT event_id AS anchor_id, epoch_us(ts) AS us FROM events WHERE event_type = 'purchase'),
j AS (SELECT a.anchor_id, ev.us, ev.seq, ev.channel, row_number() OVER (PARTITION BY a.anchor_id ORDER BY ev.us DESC, ev.seq DESC) AS r, count(*) OVER (PARTITION BY a.anchor_id) AS c
  FROM a JOIN ev ON ev.us <= a.us) """


@query(_CTX + "SELECT anchor_id, least(c, 100) - r AS index, us, seq, channel FROM j WHERE r <= 100")
def as_of_context_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = asof.context_rows(inputs.events(spark, sf_dir), inputs.anchors(spark, sf_dir))
    return rows.select("anchor_id", "index", "us", "seq", "channel")


@query(_CTX + "SELECT a.anchor_id, count(r) AS size, min(j.us) AS first_us, max(j.us) AS last_us FROM a LEFT JOIN j ON a.anchor_id = j.anchor_id AND r <= 100 GROUP BY 1")
def as_of_context_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = asof.contexts(inputs.events(spark, sf_dir), inputs.anchors(spark, sf_dir))
    at = lambda f: f(F.transform("context", lambda e: e["us"]))
    return rows.select("anchor_id", F.size("context").cast("long").alias("size"), at(F.array_min).alias("first_us"), at(F.array_max).alias("last_us"))


@query(f"""WITH {_EV}, a AS (SELECT event_id AS anchor_id, epoch_us(ts) AS us FROM events WHERE event_type = 'purchase'),
p AS (SELECT anchor_id, 'past' AS side, ev.seq, row_number() OVER (PARTITION BY anchor_id ORDER BY ev.us DESC, ev.seq DESC) AS r, count(*) OVER (PARTITION BY anchor_id) AS c FROM a JOIN ev ON ev.us <= a.us),
f AS (SELECT anchor_id, 'future' AS side, ev.seq, row_number() OVER (PARTITION BY anchor_id ORDER BY ev.us, ev.seq) AS r FROM a JOIN ev ON ev.us > a.us),
n AS (SELECT anchor_id, count(*) AS before_available FROM a JOIN ev ON ev.us <= a.us GROUP BY 1)
SELECT x.anchor_id, side, index, seq, before_available, (SELECT count(*) FROM ev) - before_available AS after_available
FROM (SELECT anchor_id, side, least(c, 20) - r AS index, seq FROM p WHERE r <= 20 UNION ALL SELECT anchor_id, side, r - 1, seq FROM f WHERE r <= 30) x JOIN n ON x.anchor_id = n.anchor_id""")
def logs_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = asof.around(inputs.events(spark, sf_dir), inputs.anchors(spark, sf_dir), 20, 30)
    return rows.select("anchor_id", "side", "index", "seq", "before_available", "after_available")


@query(f"WITH {_EV} SELECT seq, row_number() OVER (ORDER BY us, seq) - 1 AS pos FROM ev")
def event_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(inputs.events(spark, sf_dir), "us", ["seq"]).select("seq", "pos")


# Ingestion and increments

_CUT = 1_705_276_800_000_000  # 2024-01-15 UTC


@query(f"WITH {_EV} SELECT channel, seq, us FROM ev WHERE us >= {_CUT}")
def cutover_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.since(inputs.events(spark, sf_dir), _CUT).select("channel", "seq", "us")


@query(f"WITH {_EV} SELECT seq, channel, row_number() OVER (ORDER BY us, seq) AS position FROM ev")
def merged_stream_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.events(spark, sf_dir).select("us", "channel", "seq")
    streams = [e.where(F.col("channel") == c) for c in ("click", "view", "purchase")]
    rest = e.where(~F.col("channel").isin("click", "view", "purchase"))
    whole = streams[0].unionByName(streams[1]).unionByName(streams[2]).unionByName(rest)
    return positions(whole, "us", ["seq"]).select("seq", "channel", (F.col("pos") + 1).alias("position"))


def _cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.cursors(inputs.events(spark, sf_dir).where(F.col("us") < _CUT))


_CUR = f"cur AS (SELECT channel, max(us) AS c FROM ev WHERE us < {_CUT} GROUP BY 1)"


@query(f"WITH {_EV}, {_CUR} SELECT ev.channel, count(*) AS pending FROM ev JOIN cur ON ev.channel = cur.channel WHERE us > c GROUP BY 1")
def pending_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.pending(inputs.events(spark, sf_dir), _cursor(spark, sf_dir))


@query(f"WITH {_EV}, {_CUR} SELECT ev.channel, seq, us FROM ev JOIN cur ON ev.channel = cur.channel WHERE us > c")
def cursor_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.split(inputs.events(spark, sf_dir), _cursor(spark, sf_dir))[0].select("channel", "seq", "us")


@query(f"WITH {_EV}, {_CUR} SELECT ev.channel, seq FROM ev JOIN cur ON ev.channel = cur.channel WHERE us <= c")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.split(inputs.events(spark, sf_dir), _cursor(spark, sf_dir))[1].select("channel", "seq")


@query(f"WITH {_EV} SELECT channel, max(us) AS us, arg_max(seq, us) AS seq FROM ev GROUP BY 1")
def cursor_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = incremental.cursors(inputs.events(spark, sf_dir))
    return incremental.advanced(_cursor(spark, sf_dir), new)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) + 978307200 AS shifted, coalesce(nullif(json_extract_string(props, '$.title'), ''), '') AS title FROM events")
def json_payload_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronolith.sources.readers import number

    rows = inputs.table(spark, sf_dir, "events").withColumn("doc", F.try_parse_json("props"))
    shifted = (number(F.col("doc"), "$.k") + time.EPOCH_2001).cast("long")
    return rows.select("event_id", shifted.alias("shifted"), words.json_text(F.col("doc"), "title").alias("title"))


@query("SELECT page_id, regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$') AS name, 'screenshots/' || regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$') AS image FROM pages")
def url_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "pages")
    return rows.select("page_id", words.base_name(F.col("url")).alias("name"), ingest.image_path(F.lit("screen"), F.col("url")).alias("image"))


@query("SELECT doc_id, substr(replace(text, chr(10), ' '), 1, 60) AS preview, substr(text, 1, 200) AS head FROM documents")
def text_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents")
    return rows.select("doc_id", words.preview(F.col("text")).alias("preview"), F.substring("text", 1, 200).alias("head"))


@query("SELECT d.doc_id, coalesce(nullif(CASE WHEN toxic = 1 THEN '' ELSE source END, ''), nullif(lang, ''), '') AS title FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def first_nonempty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "documents").drop("text").join(inputs.table(spark, sf_dir, "labels"), "doc_id", "left")
    own = F.when(F.col("toxic") == 1, "").otherwise(F.col("source"))
    return rows.select("doc_id", words.first_text(own, F.col("lang"), default="").alias("title"))


# Themes and links

_LI = "li AS (SELECT l_orderkey AS position, epoch_us(l_shipdate) AS us, l_quantity, l_discount, l_tax FROM lineitem)"


@query(f"WITH {_LI} SELECT o_orderkey AS position, min(us) AS us FROM orders LEFT JOIN li ON position = o_orderkey GROUP BY 1")
def goal_min_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return themes.theme_inputs(inputs.themes(spark, sf_dir)).select("position", "us")


@query(f"WITH {_LI} SELECT o_orderkey AS position, max(l_quantity) AS usefulness, max(l_discount) AS confidence, max(l_tax) AS disregard FROM orders LEFT JOIN li ON position = o_orderkey GROUP BY 1")
def goal_max_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return themes.theme_inputs(inputs.themes(spark, sf_dir)).select("position", "usefulness", "confidence", "disregard")


_LINKS = f"""{_LI}, t AS (SELECT o_orderkey AS position, min(us) AS us FROM orders LEFT JOIN li ON position = o_orderkey GROUP BY 1),
ln AS (SELECT * FROM (SELECT o_orderkey AS position, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nxt, epoch_us(o_orderdate) AS best_us FROM orders) WHERE nxt IS NOT NULL),
lt AS (SELECT ln.position, coalesce(least(a.us, b.us), best_us) AS us FROM ln JOIN t a ON a.position = ln.position JOIN t b ON b.position = ln.nxt)"""


@query(f"WITH {_LINKS} SELECT position, us FROM lt")
def link_time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return themes.link_times(inputs.links(spark, sf_dir), inputs.themes(spark, sf_dir)).select("position", "us")


@query(f"""WITH {_LINKS} SELECT row_number() OVER (ORDER BY us NULLS LAST, k, position) - 1 AS input_index, type, position, us FROM
(SELECT 'goal' AS type, 0 AS k, position, us FROM t UNION ALL SELECT 'bridge', 1, position, us FROM lt)""")
def inputs_union_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs.themes(spark, sf_dir)
    goals = themes.theme_inputs(t).select("type", "position", "us")
    links = themes.link_times(inputs.links(spark, sf_dir), t).select(F.lit("bridge").alias("type"), "position", "us")
    return themes.sorted_inputs(goals.unionByName(links)).select("input_index", "type", "position", "us")


# Opportunities

_OPP = """o AS (SELECT o_custkey AS input_index, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS goal_index
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
p AS (SELECT input_index, goal_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS opportunity_index,
  'order ' || l_orderkey AS goal, CASE WHEN l_returnflag <> 'R' THEN epoch_us(l_shipdate) END AS us, l_partkey || '-' || l_suppkey AS suggestion
  FROM lineitem JOIN o ON l_orderkey = o_orderkey)"""


@query(f"WITH {_OPP} SELECT input_index || '_' || goal_index || '_' || opportunity_index AS opportunity_id, input_index, goal_index, opportunity_index, goal, us, suggestion FROM p")
def flatten_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opportunities.flattened(inputs.opportunities(spark, sf_dir))


@query(f"WITH {_OPP} SELECT row_number() OVER (ORDER BY us NULLS LAST, input_index, goal_index, opportunity_index) AS sequence_index, input_index, goal_index, opportunity_index, us FROM p")
def sequence_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = opportunities.sequenced(opportunities.flattened(inputs.opportunities(spark, sf_dir)))
    return rows.select("sequence_index", "input_index", "goal_index", "opportunity_index", "us")


@query(f"WITH {_OPP} SELECT count(*) AS seeds, count(*) FILTER (us IS NULL) AS missing_instants, count(DISTINCT input_index) AS inputs FROM p")
def opportunity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opportunities.counted(opportunities.flattened(inputs.opportunities(spark, sf_dir)))


@query("SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 5 AS batch, doc_id FROM documents")
def batch_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return opportunities.batched(inputs.table(spark, sf_dir, "documents").select("doc_id"), 5, "doc_id")


@query("SELECT o_orderkey, CAST(split_part(id, '_', 1) AS BIGINT) AS a, CAST(split_part(id, '_', 3) AS BIGINT) AS c, try_cast(nullif(split_part(id, '_', 4), '') AS BIGINT) AS d FROM (SELECT o_orderkey, o_custkey || '_' || o_orderkey || '_' || (o_orderkey % 7) AS id FROM orders)")
def id_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders").withColumn("id", words.triple_id(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderkey") % 7))
    return rows.select("o_orderkey", words.split_triple(F.col("id"), 1).alias("a"), words.split_triple(F.col("id"), 3).alias("c"), words.split_triple(F.col("id"), 4).alias("d"))


# Rankings

_RK = "rk AS (SELECT doc_id, lang, source, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents), rc AS (SELECT count(*) AS c FROM documents)"


def _half_even(scale: int) -> str:
    n, d = f"((c - rank) * {scale})", "greatest(c - 1, 1)"
    return f"CASE WHEN c <= 1 THEN {scale} ELSE {n} // {d} + CASE WHEN 2 * ({n} % {d}) > {d} OR (2 * ({n} % {d}) = {d} AND ({n} // {d}) % 2 <> 0) THEN 1 ELSE 0 END END"


@query(f"WITH {_RK} SELECT doc_id, rank, c AS rank_count, ({_half_even(10000)}) / 100.0::DOUBLE AS rank_percentile, greatest(1, {_half_even(100)}) AS value_estimate FROM rk, rc")
def rank_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.percentiles(inputs.ranking(spark, sf_dir).select("doc_id", "rank"))


@query(f"WITH {_RK} SELECT rk.doc_id, rank, coalesce(CASE WHEN toxic = 1 THEN 'toxic' END, lang) AS lang FROM rk LEFT JOIN labels l ON rk.doc_id = l.doc_id")
def rank_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = inputs.table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "toxic").alias("lang"))
    return ranking.enriched(inputs.ranking(spark, sf_dir).select("doc_id", "rank", "lang"), seeds, "doc_id", "lang")


@query(f"WITH {_RK} SELECT rk.doc_id, rank, c AS rank_count, quality FROM rk JOIN labels l ON rk.doc_id = l.doc_id, rc")
def rank_inner_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.ranked(inputs.ranking(spark, sf_dir).select("doc_id", "rank"), inputs.table(spark, sf_dir, "labels"), "doc_id")
    return rows.select("doc_id", "rank", "rank_count", "quality")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def rank_missing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.missing(inputs.table(spark, sf_dir, "documents").select("doc_id"), inputs.table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def rank_unknown_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = inputs.table(spark, sf_dir, "documents").where("lang = 'en'")
    return ranking.unknown(inputs.table(spark, sf_dir, "labels"), some, "doc_id").select("doc_id")


_SCORED = ", ".join(f"CASE WHEN NOT coalesce((doc_id + {i}) % 12 BETWEEN 1 AND 10, false) THEN '{s}' END" for i, s in enumerate(ranking.SCORES))


@query(f"""WITH {_RK} SELECT doc_id, array_to_string(list_filter([CASE WHEN lang <> 'en' THEN 'unknown' END, {_SCORED},
  CASE WHEN doc_id % 4 = 3 THEN 'intervention_posture' END, CASE WHEN doc_id % 5 = 0 THEN 'self_done_reason' END], lambda x: x IS NOT NULL), ',') AS violations FROM rk""")
def score_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = inputs.ranking(spark, sf_dir)
    posture = F.element_at(F.array(*(F.lit(p) for p in (*ranking.POSTURES, "loud"))), (F.col("doc_id") % 4 + 1).cast("int"))
    rows = r.select(F.col("doc_id").cast("string").alias("seed_id"), "doc_id", "rank", *(((F.col("doc_id") + i) % 12).alias(s) for i, s in enumerate(ranking.SCORES)), posture.alias("intervention_posture"), F.lit("none").alias("negative_reason"), *(F.when((F.lit(t) == "self_done_reason") & (F.col("doc_id") % 5 == 0), "").otherwise("x").alias(t) for t in ranking.TEXTS))
    seeds = r.where("lang = 'en'").select(F.col("doc_id").cast("string").alias("seed_id"))
    return ranking.violations(rows, seeds).select("doc_id", F.array_join("violations", ",").alias("violations"))


# Samples

@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) AS r, count(*) OVER () AS c FROM documents) WHERE r <= greatest(1, floor(c * 0.1))""")
def uniform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform(inputs.table(spark, sf_dir, "documents").select("doc_id"), 0.1, "0", "doc_id")


@query(f"""WITH {_RK}, k AS (SELECT doc_id, rank, c, greatest(1, CAST(floor(c * 0.1) AS BIGINT)) AS k FROM rk, rc),
r AS (SELECT doc_id, rank, (rank * k + c - 1) // c - 1 AS run FROM k)
SELECT doc_id, rank, run FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY md5('0:' || doc_id), doc_id) AS f FROM r) WHERE f = 1""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.by_run(inputs.ranking(spark, sf_dir).select("doc_id", "rank"), 0.1, "0", "doc_id", "rank")


@query("""WITH s AS (SELECT doc_id FROM documents ORDER BY doc_id OFFSET 10), k AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) AS r, count(*) OVER () AS c FROM s)
SELECT doc_id FROM k WHERE r <= greatest(1, floor(c * 0.1)) ORDER BY doc_id LIMIT 7""")
def sample_before_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.staged(inputs.table(spark, sf_dir, "documents").select("doc_id"), 10, 0.1, "0", "doc_id", 7, "doc_id")


# Pairs

_PAIRS = """t AS (SELECT conv_id, turn, text, role, lead(text) OVER w AS answer, lead(role) OVER w AS answers FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS q_id, text AS question, answer FROM t WHERE role = 'user' AND answers = 'assistant')"""


@query(f"""WITH {_PAIRS} SELECT CAST(conv_id AS VARCHAR) AS doc_key, CASE WHEN conv_id % 2 = 0 THEN conv_id % 3 ELSE 0 END AS thread_id, q_id, question, answer, CASE WHEN q_id % 2 = 0 THEN 'even' END AS category,
  CASE WHEN conv_id % 5 <> 0 THEN 'type' || (conv_id % 3) END AS qa_type FROM q WHERE question IS NOT NULL AND answer IS NOT NULL""")
def qa_pairs_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.training_rows(inputs.documents(spark, sf_dir)).select("doc_key", "thread_id", "q_id", "question", "answer", "category", "qa_type")


@query(f"""WITH {_PAIRS} SELECT CAST(conv_id AS VARCHAR) AS doc_key, q_id AS pair_position, '{{"answer":' || to_json(answer) || CASE WHEN q_id % 2 = 0 THEN ',"category":"even"' ELSE '' END
  || ',"context_events":[{{"connector":"screen","index":0,"text":"","ts":0.0,"ts_iso":"1970-01-01T00:00:00Z"}}],"q_id":' || q_id
  || CASE WHEN conv_id % 5 <> 0 THEN ',"qa_type":"type' || (conv_id % 3) || '"' ELSE '' END || ',"question":' || to_json(question) || ',"thread_id":' || CASE WHEN conv_id % 2 = 0 THEN conv_id % 3 ELSE 0 END || '}}' AS json FROM q""")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.as_json(pairs.training_rows(inputs.documents(spark, sf_dir))).select("doc_key", "pair_position", "json")


@query(f"WITH {_PAIRS} SELECT CAST(conv_id AS VARCHAR) AS doc_key, count(*) AS pair_count, arg_min(question, q_id) AS sample_question FROM q GROUP BY 1")
def qa_counts_and_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.counts(inputs.documents(spark, sf_dir)).select("doc_key", "pair_count", "sample_question")


@query(f"WITH {_PAIRS} SELECT CAST(conv_id AS VARCHAR) AS doc_key, count(*) BETWEEN 3 AND 10 AS enough FROM q GROUP BY 1")
def pair_budget_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(pairs.all_pairs(F.col("qa_pairs"), F.col("threads")))
    return inputs.documents(spark, sf_dir).select("doc_key", n.between(validate.LEAST, validate.MOST).alias("enough"))


@query(f"""WITH {_EV}, e AS (SELECT seq, us, [ 'H', 'F', 'H+F' ][seq % 3 + 1] AS basis, us + (seq % 5 - 2) * 700 AS verify_us FROM ev)
SELECT seq, basis, CASE WHEN basis = 'H' THEN verify_us <= us + 1000 ELSE verify_us >= us - 1000 END AS grounded FROM e""")
def grounding_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = inputs.events(spark, sf_dir)
    basis = F.element_at(F.array(F.lit("H"), F.lit("F"), F.lit("H+F")), (F.col("seq") % 3 + 1).cast("int"))
    rows = e.select("seq", "us", basis.alias("basis"), (F.col("us") + (F.col("seq") % 5 - 2) * 700).alias("verify_us"))
    return rows.select("seq", "basis", validate.grounded(F.col("basis"), F.col("verify_us"), F.col("us")).alias("grounded"))


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT) < event_id % 100, false) AS resolvable FROM events")
def evidence_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "events").withColumn("k", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint"))
    pair = F.struct(F.struct(F.array("k").alias("context_event_indexes"), F.lit("r").alias("reason")).alias("question_basis"))
    ok = validate.basis_ok(F.col("pair"), F.col("event_id") % 100)
    return rows.withColumn("pair", pair).select("event_id", ok.alias("resolvable"))


# Work and runs

@query("SELECT doc_id, k AS qa_type FROM documents, (SELECT unnest(['timing', 'curiosity', 'disregard', 'value', 'threaded']) AS k)")
def work_items_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.work_items(inputs.table(spark, sf_dir, "documents").select("doc_id"), list(validate.SEED_TYPES))


@query("SELECT doc_id, k AS qa_type FROM documents, (SELECT unnest(['timing', 'value']) AS k) WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR k <> 'timing'")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = generate.work_items(inputs.table(spark, sf_dir, "documents").select("doc_id"), ["timing", "value"])
    done = inputs.table(spark, sf_dir, "labels").select("doc_id", F.lit("timing").alias("qa_type"))
    return generate.todo(items, done, "doc_id", "qa_type")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS run, count(*) FILTER (s = 'themes') AS theme_count, bool_or(s = 'themes') AS has_themes, bool_or(s = 'combined') AS has_combined, bool_or(s = 'questions') AS has_questions
FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'O' THEN 'themes' WHEN 'F' THEN 'combined' ELSE 'questions' END AS s FROM orders) GROUP BY 1""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.when(F.col("o_orderstatus") == "O", "themes").when(F.col("o_orderstatus") == "F", "combined").otherwise("questions")
    rows = inputs.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("run"), stage.alias("stage"), F.col("o_orderdate").alias("modified"))
    return api.runs(rows).select("run", "theme_count", "has_themes", "has_combined", "has_questions")


@query("SELECT max(CAST(o_custkey AS VARCHAR)) AS run FROM orders")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.latest_run(inputs.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("run")))


@query(f"""WITH {_LI}, n AS (SELECT position, count(*) AS c FROM li GROUP BY 1)
SELECT o_orderkey AS position, coalesce(c, 0) AS source_count, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_opportunities,
  coalesce((SELECT string_agg(l_linenumber || '', ',' ORDER BY l_linenumber || '') FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45), '') AS questions
FROM orders LEFT JOIN n ON position = o_orderkey""")
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = inputs.table(spark, sf_dir, "lineitem")
    opp = li.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("input_index"))
    asked = li.where("l_quantity > 45").select(F.col("l_orderkey").alias("input_index"), F.col("l_linenumber").cast("string").alias("question_id"))
    rows = api.manifest(inputs.themes(spark, sf_dir), opp, asked)
    return rows.select("position", "source_count", "has_opportunities", F.array_join("question_ids", ",").alias("questions"))


@query("""WITH s AS (SELECT DISTINCT CASE WHEN n_nationkey = 0 THEN 'global' ELSE 'days_' || n_nationkey END AS scope, n_nationkey AS k FROM nation) SELECT scope, row_number() OVER (ORDER BY k) AS position FROM s""")
def natural_sort_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = F.when(F.col("n_nationkey") == 0, "global").otherwise(F.concat(F.lit("days_"), F.col("n_nationkey").cast("string")))
    return api.scopes(inputs.table(spark, sf_dir, "nation").select(scope.alias("scope")))


@query(f"WITH {_EV} SELECT user_id, seq, channel FROM (SELECT *, row_number() OVER (PARTITION BY user_id, channel ORDER BY us, seq) AS r FROM ev) WHERE r = 1")
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.first_of_each(inputs.events(spark, sf_dir), ["user_id", "channel"], "us", "seq").select("user_id", "seq", "channel")


@query("SELECT c_custkey AS index, r.first, r.last FROM customer JOIN (SELECT p_partkey * 5 AS first, p_partkey * 5 + 4 AS last FROM part) r ON c_custkey BETWEEN r.first AND r.last")
def range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = inputs.table(spark, sf_dir, "part").select((F.col("p_partkey") * 5).alias("first"), (F.col("p_partkey") * 5 + 4).alias("last"))
    return api.containing(ranges, inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("index")))


@query("""SELECT o_custkey || '-' || rank AS id, o_custkey AS interval_index, rank, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank FROM orders)""")
def theme_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = inputs.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("interval_index")).agg(F.sort_array(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("items"))
    return api.theme_list(nested).drop("o_orderdate")


@query("""SELECT o_orderkey, strftime(o_orderdate + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS utc FROM orders""")
def mail_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders")
    sent = F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss"), F.lit(" -0700 (PDT)"))
    return rows.select("o_orderkey", time.parse_mail_date(sent).alias("utc"))


@query(f"""WITH {_EV} SELECT seq, us, {_utc_iso('us')} AS ts_iso, 'notifications' AS channel, props AS text, json_extract_string(props, '$.k') AS k FROM ev""")
def channel_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.events(spark, sf_dir).withColumn("source", F.try_parse_json("props"))
    made = ingest.normalised(rows.select("us", F.concat_ws("|", F.col("seq").cast("string"), F.col("text")).alias("text"), "source"), "notifications")
    number = F.substring_index("text", "|", 1)
    k = F.try_variant_get(F.element_at("source", "k"), "$", "string")
    return made.select(number.cast("long").alias("seq"), "us", "ts_iso", "channel", F.expr("substr(text, length(substring_index(text, '|', 1)) + 2)").alias("text"), k.alias("k"))


@query(f"WITH {_PAIRS} SELECT DISTINCT CAST(conv_id AS VARCHAR) AS doc_key, CASE WHEN conv_id % 5 <> 0 THEN 'type' || (conv_id % 3) END AS qa_type FROM q WHERE conv_id IN (SELECT l_orderkey FROM lineitem)")
def consolidated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = inputs.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("doc_key"))
    return pairs.consolidated(inputs.documents(spark, sf_dir), wanted=wanted).select("doc_key", "qa_type")


@query("SELECT batch, count(*) AS size, min(doc_id) AS first_id FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 7 AS batch FROM documents) GROUP BY 1")
def batch_nests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = opportunities.batched(inputs.table(spark, sf_dir, "documents").select("doc_id", "lang"), 7, "doc_id")
    nested = opportunities.nested_batches(rows, order="doc_id")
    return nested.select("batch", F.size("items").cast("long").alias("size"), F.element_at("items", 1)["doc_id"].alias("first_id"))


@query("""SELECT o_custkey || '_' || o_orderkey || '_0' AS question_id, o_custkey AS input_index, o_orderkey AS goal_index, CAST(0 AS BIGINT) AS opportunity_index,
  CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE o_orderstatus END AS title FROM orders""")
def question_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "orders").select(words.triple_id(F.col("o_custkey"), F.col("o_orderkey"), F.lit(0)).alias("question_id"), F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus")).alias("suggestion_title"), F.lit(None).cast("string").alias("suggestion"), F.col("o_orderpriority").alias("action"), F.lit("x").alias("goal"))
    return api.question_list(rows)


@query(f"""WITH {_OPP}, s AS (SELECT row_number() OVER (ORDER BY us NULLS LAST, input_index, goal_index, opportunity_index) AS n, * FROM p)
SELECT n AS sequence_index, '## ' || n || '. ' || coalesce(strftime({_LOCAL.format('us')}, '%a %b %-d, %-I:%M %p'), 'Missing timestamp') || ' - Untitled' || chr(10) || chr(10)
  || '- Source: `' || input_index || '_' || goal_index || '_' || opportunity_index || '`' || chr(10) || '- Goal: ' || goal || chr(10) || '- Suggestion: ' || suggestion || chr(10)
  || '- Why now: ' || chr(10) || '- Action: ' || chr(10) || '- Expected artifact: ' || chr(10) AS lines FROM s""")
def opportunity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = opportunities.sequenced(opportunities.flattened(inputs.opportunities(spark, sf_dir)))
    none = F.lit(None).cast("string")
    return opportunities.report(rows.withColumns({c: none for c in ("title", "why_now", "action", "expected_artifact")}))


def _stubbed(size: str) -> str:
    """What the stand-in answers to a prompt of so many characters."""
    one = lambda i: f"""'{{"answer": "Answer ' || ({size} + {i}) || '.", "q_id": {i}, "question": "Question {i} of ' || {size} || ' characters?"}}'"""
    return f"""'{{"qa_pairs": [' || {one(0)} || ', ' || {one(1)} || ', ' || {one(2)} || ']}}'"""


@query(f"""WITH b AS (SELECT o_orderkey, o_orderstatus, (row_number() OVER (ORDER BY o_orderkey) - 1) // 5 AS batch FROM orders),
s AS (SELECT batch, length('Rows: [' || string_agg('{{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}}', ',' ORDER BY o_orderkey) || ']') AS n FROM b GROUP BY 1)
SELECT batch, {_stubbed('n')} AS output, 'ok' AS status, CAST(NULL AS VARCHAR) AS error FROM s""")
def generated_batches_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One call for each batch of five rows, answered by the deterministic stand-in."""
    rows = opportunities.batched(inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), 5, "o_orderkey")
    return generate.run_batches(rows, generate.stub, "Rows: {rows}", "batch", "o_orderkey")


@query(f"""WITH {_EV}, {_BK}, {_INTERVALS}, p AS (SELECT interval_index, 'Interval ' || interval_index || ': ' || {_utc_iso('start_us')} || ' to ' || {_utc_iso('end_us')} || ', ' || event_count || ' events.' AS prompt FROM iv)
SELECT interval_index, prompt, {_stubbed('length(prompt)')} AS output, 'ok' AS status FROM p""")
def generated_pairs_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts from interval rows answered by the deterministic stand-in."""
    rows = intervals.activity(inputs.events(spark, sf_dir)).select("interval_index", "start_utc", "end_utc", "event_count")
    asked = generate.prompts(rows, "Interval {i}: {a} to {b}, {n} events.", i="interval_index", a="start_utc", b="end_utc", n="event_count")
    return generate.published(generate.run(asked, generate.stub)).select("interval_index", "prompt", "output", "status")


from chronolith.plans import checks  # noqa: E402, F401  its queries join these
