"""One query for each operator, with production parameters, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.llm import alignment, bpe, chat, collocations, common, jaccard, language, merkle, mixing, passages, quality, secrets, toxicity, vectors


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held = common.bucket_of(F.col("doc_id"), 4) == 2
    out = toxicity.score(documents.select("doc_id", "text"), labels.where(~held))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    held = common.bucket_of(F.col("doc_id"), 5) == 0
    out = quality.score(documents.select("doc_id", "text"), labels.where(~held))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compared(common.table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.taken(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(common.table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return bpe.digests(out)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_model")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(common.table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(common.table(spark, sf_dir, "conversations"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(common.table(spark, sf_dir, "embeddings"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeats(common.table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined(common.table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.compared(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(common.bucket_of(F.col("doc_id"), 7) == 2, F.lit(False))
    out = language.scored(common.table(spark, sf_dir, "documents").select("doc_id", "text"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
