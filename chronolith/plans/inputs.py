"""The driver's tables seen as the engine's logical inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronolith.functions import time
from chronolith.operators.order import numbered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """us, channel, seq, text and source of the event log."""
    e = table(spark, sf_dir, "events")
    return e.select(time.micros(F.col("ts")).alias("us"), F.col("event_type").alias("channel"), F.col("event_id").alias("seq"), F.col("props").alias("text"), F.col("user_id"), F.col("value"), F.col("props"))


def anchors(spark: SparkSession, sf_dir: str, kind: str = "purchase") -> DataFrame:
    """Anchors for as-of joins: the events of one type."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    return e.select(F.col("event_id").alias("anchor_id"), time.micros(F.col("ts")).alias("us"))


def themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as themes, their lines as sources."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("position"), F.struct(time.micros(F.col("l_shipdate")).alias("us"), F.col("l_quantity").alias("usefulness"), F.col("l_discount").alias("confidence"), F.col("l_tax").alias("disregard")).alias("s"))
    nested = lines.groupBy("position").agg(F.collect_list("s").alias("sources"))  # a few lines an order
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("position"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"), F.col("o_custkey").alias("owner"), time.micros(F.col("o_orderdate")).alias("best_us"))
    none = F.expr("cast(array() as array<struct<us:bigint,usefulness:double,confidence:double,disregard:double>>)")
    return orders.join(nested, "position", "left").withColumn("sources", F.coalesce("sources", none))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the customer's next one as a link."""
    o = table(spark, sf_dir, "orders")
    nxt = F.lead("o_orderkey").over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    rows = o.withColumn("next", nxt).where("next IS NOT NULL")
    return rows.select(F.col("o_orderkey").alias("position"), F.array("o_orderkey", "next").alias("members"), time.micros(F.col("o_orderdate")).alias("best_us"))


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches: customers hold orders as goals, orders hold lines as opportunities."""
    li = table(spark, sf_dir, "lineitem")
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.when(F.col("l_returnflag") != "R", time.micros(F.col("l_shipdate"))).alias("us"), F.col("l_shipdate").cast("string").alias("title"))
    per_order = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    opps = F.transform("lines", lambda x: F.struct(x["us"].alias("us"), F.concat_ws("-", x["l_partkey"].cast("string"), x["l_suppkey"].cast("string")).alias("suggestion")))
    orders = table(spark, sf_dir, "orders").join(per_order, "o_orderkey").select("o_custkey", F.struct("o_orderdate", "o_orderkey", F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("goal"), opps.alias("opportunities")).alias("g"))
    per = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(F.col("g.o_orderdate").alias("d"), F.col("g.o_orderkey").alias("k"), F.col("g.goal").alias("goal"), F.col("g.opportunities").alias("opportunities")))).alias("gs"))
    goals = F.transform("gs", lambda g: F.struct(g["goal"].alias("goal"), g["opportunities"].alias("opportunities")))
    return per.select(F.array(F.struct(F.col("o_custkey").alias("input_index"), goals.alias("goals"))).alias("items"))


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents ranked by length."""
    d = table(spark, sf_dir, "documents")
    return numbered(d.select("doc_id", "lang", "source", "n_chars"), "rank", F.desc("n_chars"), "doc_id").drop("n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as question documents: a user's turn and the answer after it are a pair."""
    c = table(spark, sf_dir, "conversations")
    order = W.partitionBy("conv_id").orderBy("turn")
    rows = c.withColumn("answer", F.lead("text").over(order)).withColumn("answers", F.lead("role").over(order))
    rows = rows.where("role = 'user' AND answers = 'assistant'")
    pair = F.struct("turn", F.col("text").alias("question"), F.col("answer").alias("answer"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(pair)).alias("p"))
    null = lambda t: F.lit(None).cast(t)
    basis = "struct<context_event_indexes:array<bigint>,reason:string>"
    pairs = F.transform("p", lambda p, i: F.struct(i.cast("long").alias("q_id"), p["question"].alias("question"), p["answer"].alias("answer"), F.when(i % 2 == 0, "even").alias("category"), null("string").alias("timescale"), null("string").alias("answer_basis"), null("bigint").alias("verify_us"), null("string").alias("verify_at_iso"), null(basis).alias("question_basis"), null("string").alias("why_it_matters"), null("string").alias("evidence_grounding"), null("double").alias("question_difficulty")))
    context = F.array(F.struct(F.lit(0).cast("long").alias("index"), F.lit(0.0).alias("ts"), F.lit("1970-01-01T00:00:00Z").alias("ts_iso"), F.lit("screen").alias("channel"), F.lit("").alias("text")))
    from chronolith.operators.pairs import THREAD

    threaded = F.col("conv_id") % 2 == 0
    threads = F.array(F.struct((F.col("conv_id") % 3).alias("thread_id"), pairs.alias("qa_pairs")))
    return rows.select(F.col("conv_id").cast("string").alias("doc_key"), F.when(F.col("conv_id") % 5 != 0, F.concat(F.lit("type"), (F.col("conv_id") % 3).cast("string"))).alias("qa_type"), (F.col("conv_id") * 1_000_000).alias("cutoff_us"), context.alias("context"), F.when(threaded, threads).otherwise(null(f"array<{THREAD}>")).alias("threads"), F.when(~threaded, pairs).alias("qa_pairs"))
