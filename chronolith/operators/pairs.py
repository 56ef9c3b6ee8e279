"""Question and answer documents: flat or threaded, with their context, flattened to training rows or nested again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EVENT = "struct<index:bigint,ts:double,ts_iso:string,channel:string,text:string>"
PAIR = "struct<q_id:bigint,question:string,answer:string,category:string,timescale:string,answer_basis:string,verify_us:bigint,verify_at_iso:string,question_basis:struct<context_event_indexes:array<bigint>,reason:string>,why_it_matters:string,evidence_grounding:string,question_difficulty:double>"
THREAD = f"struct<thread_id:bigint,qa_pairs:array<{PAIR}>>"
DOCUMENT = f"doc_key string, qa_type string, cutoff_us bigint, context array<{EVENT}>, threads array<{THREAD}>, qa_pairs array<{PAIR}>"


def all_pairs(flat: Column, threads: Column) -> Column:
    """The flat pairs, else those of all threads; null where there is neither."""
    of_threads = F.flatten(F.transform(threads, lambda t: F.coalesce(t["qa_pairs"], F.expr(f"cast(array() as array<{PAIR}>)"))))
    return F.coalesce(flat, of_threads)


def with_category(pairs: Column, category: Column) -> Column:
    """pairs whose missing category is filled in."""
    return F.transform(pairs, lambda p: p.withField("category", F.coalesce(p["category"], category)))


def attached(documents: DataFrame, prefix: str = "") -> DataFrame:
    """documents with the pairs' categories defaulting to their type."""
    category = F.concat(F.lit(prefix), F.col("qa_type"))
    threads = F.transform("threads", lambda t: t.withField("qa_pairs", with_category(t["qa_pairs"], category)))
    return documents.withColumn("qa_pairs", with_category(F.col("qa_pairs"), category)).withColumn("threads", threads)


def projected(context: Column) -> Column:
    """Context events with their five fields only."""
    return F.transform(context, lambda e: F.struct(e["index"].alias("index"), e["ts"].alias("ts"), e["ts_iso"].alias("ts_iso"), e["channel"].alias("channel"), e["text"].alias("text")))


def training_rows(documents: DataFrame) -> DataFrame:
    """A row for each pair with a question and an answer: context, thread_id, q_id, question, answer, category, qa_type.

    Threads win over flat pairs; flat pairs are thread 0. Documents without context give no rows; an empty category is
    none. Order within a document: thread_position, pair_position.
    """
    flat = F.array(F.struct(F.lit(0).cast("long").alias("thread_id"), F.col("qa_pairs")))
    batches = F.when(F.col("threads").isNotNull(), F.col("threads")).when(F.col("qa_pairs").isNotNull(), flat)
    rows = documents.where("context IS NOT NULL").select("doc_key", "qa_type", projected(F.col("context")).alias("context"), F.posexplode(batches).alias("thread_position", "t"))
    rows = rows.where("t IS NOT NULL").select("doc_key", "qa_type", "context", "thread_position", F.col("t.thread_id").alias("thread_id"), F.posexplode("t.qa_pairs").alias("pair_position", "p"))
    rows = rows.where("p.question IS NOT NULL AND p.answer IS NOT NULL")
    return rows.select("doc_key", F.col("thread_position").cast("long").alias("thread_position"), F.col("pair_position").cast("long").alias("pair_position"), "context", "thread_id", F.col("p.q_id").alias("q_id"), F.col("p.question").alias("question"), F.col("p.answer").alias("answer"), F.nullif(F.col("p.category"), F.lit("")).alias("category"), "qa_type")


def as_json(rows: DataFrame) -> DataFrame:
    """doc_key, the positions and json: a training row as a line of JSON, keys sorted; category and qa_type only where
    there are any, the other keys always."""
    context = F.transform("context", lambda e: F.struct(e["channel"].alias("connector"), e["index"].alias("index"), e["text"].alias("text"), e["ts"].alias("ts"), e["ts_iso"].alias("ts_iso")))
    whole = F.to_json(F.struct("answer", "category", context.alias("context_events"), "q_id", "qa_type", "question", "thread_id"), {"ignoreNullFields": "false"})
    # Only the two optional keys go where they are null; inside texts a quote is always escaped, so these can't match one.
    line = F.replace(F.replace(whole, F.lit(',"category":null,"context_events":'), F.lit(',"context_events":')), F.lit(',"qa_type":null,"question":'), F.lit(',"question":'))
    return rows.select("doc_key", "thread_position", "pair_position", line.alias("json"))


def counts(documents: DataFrame) -> DataFrame:
    """doc_key, qa_type, pair_count and sample_question, the first that isn't empty."""
    pairs = all_pairs(F.col("qa_pairs"), F.col("threads"))
    first = F.get(F.filter(F.transform(pairs, lambda p: p["question"]), lambda q: F.length(q) > 0), F.lit(0))
    return documents.select("doc_key", "qa_type", F.coalesce(F.size(pairs), F.lit(0)).cast("long").alias("pair_count"), first.alias("sample_question"))


def first_of_each(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Of the rows of each key the first in the given order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def in_selection_order(documents: DataFrame, selection: DataFrame, key: str = "doc_key") -> DataFrame:
    """The documents of a selection (key, position) with their position, in its order; a selected key without a document
    gives no row."""
    return documents.join(selection.select(key, "position"), key).orderBy("position", "qa_type")


def changed(before: DataFrame, after: DataFrame, *keys: str) -> DataFrame:
    """Rows of after that differ from before's row of the same keys, or have none there: what has to be written again.
    Columns of maps and variants are compared as JSON."""
    plain = lambda df: df.select(*keys, F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("_json"))
    return after.join(plain(after).join(plain(before), [*keys, "_json"], "left_anti").select(*keys), list(keys), "left_semi")


def consolidated(documents: DataFrame, key: str = "doc_key", wanted: DataFrame | None = None) -> DataFrame:
    """The documents of all types as one ordered table, only those of wanted keys if given."""
    rows = documents if wanted is None else documents.join(wanted.select(key).distinct(), key, "left_semi")
    return rows.orderBy(key, "qa_type")
