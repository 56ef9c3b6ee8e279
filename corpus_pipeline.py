"""From raw documents to token ids: toxicity, near duplicates, secrets, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. docs may hold other columns than
those of documents; they go. An empty table gives no rows at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolith.llm import bpe, common, jaccard, mixing, secrets, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from the labelled rows outside the held-out fold.

    Null and empty texts hold no evidence and stay, with a model for which that isn't enough to reject; long texts are read
    whole. Repeated rows are each kept or rejected alike; rows without an id are scored too.
    """
    labels = common.table(spark, sf_dir, "labels").where(common.bucket_of(F.col("doc_id"), 4) != 2)
    return toxicity.score(docs, labels).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents with similar sets of five-word shingles the one with the smallest id stays.

    Texts without words are like nothing and stay. Of rows that repeat both id and text one stays; other rows that share
    an id are documents of their own; rows without an id give way to those with one.
    """
    return jaccard.one_of_each(docs).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret's span is marked out of the text. Null texts become empty, no row goes."""
    out = secrets.scan(docs)
    return out.withColumn("text", F.col("redacted")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each pass over its source. Documents without words have nothing to
    take, and documents of which the mix takes nothing go; a null source is a source of its own."""
    return mixing.mixed(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with the digests of the ids and of the text decoded from them. Null texts count as empty."""
    out = bpe.encode(docs.select("doc_id", "source", "text"))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return out.select("doc_id", "source", "n_tokens", "ids", sha("id_list").alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Models, random draws and the tokenizer have no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents; each result is written and read again before the next."""
    docs = common.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.written(docs, name)
    return docs
