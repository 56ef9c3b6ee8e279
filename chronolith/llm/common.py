"""Helpers that the operators share: tables, lineage cuts, hashes and Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronolith.sources.sinks import shared_folder
from chronolith.sources.sinks import stored as written  # noqa: F401  a table in the shared folder

#: White space that separates words, as one character class of Java and Python patterns.
BLANK = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and held in the shared checkpoint folder: a lost executor loses nothing of it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(column: Column, modulus: int) -> Column:
    """crc32 of the column's text, modulo: what decides the folds of labelled rows."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def least_by_hash(rows: DataFrame, most: tuple[int, int]) -> DataFrame:
    """Of rows (doc_id, label) with label 0 and 1 at most so many each, those with the smallest hash of their id."""
    order = [F.xxhash64(F.lit(17), "doc_id"), "doc_id"]
    parts = [rows.where(F.col("label") == v).orderBy(*order).limit(n) for v, n in enumerate(most)]
    return parts[0].unionByName(parts[1])


def labelled_texts(documents: DataFrame, chosen: DataFrame) -> tuple[list[str], list[int]]:
    """Texts and labels of chosen (doc_id and label of a bounded number of rows), in an order without pattern; a text for
    each id, of rows that repeat it the one with the smallest hash. Ids without a document are left out."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    found = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()
    found.sort(key=lambda r: (str(r.doc_id)[::-1], r.label))
    return [r.text for r in found], [r.label for r in found]


#: Bytes of a batch of rows on its way between Spark and Python, and rows: what a worker holds at once follows from these.
BATCH_BYTES, BATCH_ROWS = 4 * 1024 * 1024, 4096


def arrow_batches(df: DataFrame, schema: str | StructType, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """function on the Arrow batches of each task, which are held small for this session."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            tidy()

    return df.mapInArrow(each, schema)


#: What a worker remembers between calls, by name; it is forgotten when a task ends.
MEMORY: dict[str, dict] = {}


def tidy() -> None:
    """Workers serve many tasks: what one of them has used goes back to the system before the next."""
    for remembered in MEMORY.values():
        remembered.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def arrow_map(df: DataFrame, schema: str | StructType, function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """function on each Arrow batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return arrow_batches(df, schema, each)


def with_columns(df: DataFrame, more: str, function: Callable[[pa.RecordBatch, object], list[pa.Array]], model: object = None) -> DataFrame:
    """df with columns more (as DDL), which function makes of each Arrow batch and of the model, sent to every task."""
    added = StructType.fromDDL(more)
    names = [*df.columns, *added.names]
    shared = df.sparkSession.sparkContext.broadcast(model)
    return arrow_map(df, StructType([*df.schema.fields, *added.fields]), lambda batch: pa.RecordBatch.from_arrays([*batch.columns, *function(batch, shared.value)], names=names))


def runs_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours, as start and end, whose sizes sum to most or little more; a larger one is a run of its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's texts; null is empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of a well-known generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights, the intercept last, of a ridge logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * max(1, len(x)))
    penalty[-1] = 1e-9
    loss = lambda w: np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ w)).sum() + (penalty * w * w).sum() / 2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * w
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        now = loss(w)
        while np.abs(step).max() > 1e-12 and loss(w - step) > now:  # a full step may go too far
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def logistic_apply(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ w, -30, 30)))


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts (null: empty), A-Z in lower case, and the text of each, by place. White space is \\x20 and \\x09 to
    \\x0D."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = pc.list_flatten(lists)
    some = pc.not_equal(pc.binary_length(flat), 0)
    return flat.filter(some), pc.list_parent_indices(lists).filter(some).to_numpy()


def free(df: DataFrame, *names: str) -> list[str]:
    """These names, each with as many underscores behind it as make it one that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
