"""Cells: groups of rows that are compared with each other, none larger than a task can hold.

Rows that share a key form a group. A group of more than BLOCK rows is dealt into blocks by hash, and each pair of
blocks becomes a cell of its own, so a key with a third of all rows is spread over many tasks. Singles are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm import common

BLOCK = 1024


def dealt(rows: DataFrame, key: str, item: str, block: int | None = None, useful: str = "true") -> DataFrame:
    """rows (key and item, slim) with cell and side: in a cell of two blocks, the block (0 or 1) of the row, else -1.
    Groups for which the aggregate useful isn't true are left out."""
    block = block or BLOCK
    sizes = common.cut(rows.groupBy(key).agg(F.count("*").alias("members"), F.expr(useful).alias("useful")).where("members > 1 AND useful").drop("useful"))
    out = rows.join(sizes, key)
    n = F.ceil(F.col("members") / block).cast("int")
    out = out.withColumn("blocks", n).withColumn("own", F.pmod(F.xxhash64(F.lit(29), item), F.col("blocks")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), F.lit(-1)).otherwise((F.col("own") > F.col("other")).cast("int"))
    return out.select(*rows.columns, F.when(F.col("blocks") == 1, F.xxhash64(F.lit(31), key)).otherwise(F.xxhash64(F.lit(37), key, low, high)).alias("cell"), side.alias("side"))


def each_group(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], pa.RecordBatch | None], column: str = "cell", rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """work on runs of whole cells, of about so many rows, from batches that are sorted by cell. With rows 1 it is done for
    each cell by itself."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if table.num_rows and (made := work(table.combine_chunks())) is not None and made.num_rows:
            yield made

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            table = pa.Table.from_batches(held)
            keys = table.column(column).to_numpy()
            others = np.flatnonzero(keys != keys[-1])
            last = int(others[-1]) + 1 if len(others) else 0
            if rows == 1:
                starts = bounds(keys[:last]) if last else []
                for s, e in zip(starts[:-1], starts[1:], strict=True):
                    yield from out(table.slice(s, e - s))
            elif last:
                yield from out(table.slice(0, last))
            held = table.slice(last).to_batches()
            size = table.num_rows - last
    if held:
        yield from out(pa.Table.from_batches(held))


def compared(rows: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str, column: str = "cell", at_once: int = 20_000) -> DataFrame:
    """rows dealt out by cell, and work done on runs of whole cells."""
    spread = rows.repartition(common.partitions(rows.sparkSession) * 2, column).sortWithinPartitions(column)
    return common.arrow_batches(spread, schema, lambda batches: each_group(batches, work, column, at_once))


def bounds(cells: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, and the end."""
    return np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]])


def small_pairs(starts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows in the same run, of the runs with at most so many rows, in batches."""
    size = np.diff(starts)
    chosen = (size > 1) & (size <= most)
    end = np.repeat(starts[1:], size)
    ok = np.repeat(chosen, size)
    i = np.flatnonzero(ok)
    for step in range(1, int(size[chosen].max()) if chosen.any() else 0):
        i = i[i + step < end[i]]
        yield i, i + step


def binaries(table: pa.Table, name: str, dtype: str, width: int) -> np.ndarray:
    """A column of equally long binaries as a matrix."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype).reshape(table.num_rows, width)


def forest(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links i to j connect, one fewer than each part has members; equal ids are one node."""
    from chronolith.llm.components import local_roots

    nodes, at = np.unique(ids, return_inverse=True)
    root = local_roots(len(nodes), at[i], at[j])
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[moved]], nodes[moved]
