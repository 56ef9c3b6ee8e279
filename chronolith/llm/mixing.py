"""Mixing sources to target weights by index.

The words of each source are packed into fixed-length blocks, in an order of hash bucket and id. Output shards draw
how many of their slots each source fills, at random but without replacement from the slots that the targets allow
(multinomial counts given their totals). A slot's running number within its source goes through a keyed permutation of
the source's block indexes, once for each pass over the source, and the block is joined by that index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.llm import common

WORD = rf"[^{common.BLANK}]+"
BLOCK_WORDS = 128
SHARD_SLOTS = 2048
#: Shards whose draws are made in one task; their shares of each source are fixed beforehand, in proportion.
GROUP_SHARDS = 32
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: One row for each source reaches the driver and every task; more sources than this are an error, never dropped.
MOST_SOURCES = 200_000


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> list[float]:
    """Shares of the sum of sizes by weight (repeating), none above most times its size; the excess is shared again."""
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], dtype=float)
    cap = most * np.array(sizes, dtype=float)
    out, fixed = np.zeros(len(sizes)), np.zeros(len(sizes), bool)
    while not fixed.all():
        out[~fixed] = (sum(sizes) - out[fixed].sum()) * w[~fixed] / w[~fixed].sum()
        above = ~fixed & (out > cap)
        if not above.any():
            break
        out[above] = cap[above]
        fixed |= above
    return [float(x) for x in out]


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 at index: a Feistel network, walked until it lands inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def turn(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            salt = np.uint64((key * 1_000_003 + r * 7919 + 1) & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (common.mix64(right + common.mix64(np.array([salt], np.uint64))) & mask)
        return (left << np.uint64(half)) | right

    out = turn(np.asarray(index, np.uint64))
    while (outside := out >= size).any():
        out[outside] = turn(out[outside])
    return out.astype(np.int64)


@dataclass
class Plan:
    """For each source: its index, value, size, target, number of blocks, slots."""

    rows: list[tuple[int, str | None, int, float, int, int]]
    block_words: int
    seed: int

    @property
    def groups(self) -> int:
        return max(1, -(-sum(r[5] for r in self.rows) // (SHARD_SLOTS * GROUP_SHARDS)))


def plan(documents: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 1) -> Plan:
    """documents: source and size of each row."""
    found = documents.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [r["size"] for r in found]
    rows = []
    for i, (r, t) in enumerate(zip(found, targets(sizes), strict=True)):
        blocks = -(-r["size"] // block_words)
        rows.append((i, r.source, r["size"], t, blocks, min(MOST_PASSES * blocks, round(t * blocks / r["size"])) if blocks else 0))
    return Plan(rows, block_words, seed)


def slots(spark, p: Plan) -> DataFrame:
    """One row a slot of the output: shard, slot, source_id, pass, block. Spark takes this table for a tiny one (its input
    is a range of shard groups), so whoever joins it says how: it grows with the corpus and must not be broadcast."""
    groups, seed = p.groups, p.seed
    totals, blocks = np.array([r[5] for r in p.rows], np.int64), [r[4] for r in p.rows]

    def each(batches):
        for batch in batches:
            for g in batch["id"]:
                first, until = totals * g // groups, totals * (g + 1) // groups
                left, at = (until - first).copy(), first.copy()
                rng = np.random.default_rng([seed, int(g)])
                shard = 0
                while left.sum():
                    n = min(SHARD_SLOTS, int(left.sum())) if shard < GROUP_SHARDS - 1 else int(left.sum())
                    drawn = rng.multivariate_hypergeometric(left, n, method="marginals") if len(left) > 1 else np.array([n])
                    frames = []
                    for s in np.flatnonzero(drawn):
                        run = np.arange(at[s], at[s] + drawn[s])
                        turns = run // blocks[s]
                        frames.append(pd.DataFrame({"source_id": s, "pass": turns, "block": np.concatenate([permuted(run[turns == t] % blocks[s], blocks[s], (seed * 131 + int(s)) * 8 + int(t)) for t in np.unique(turns)])}))
                    out = pd.concat(frames).iloc[rng.permutation(n)]
                    yield out.assign(shard=g * GROUP_SHARDS + shard, slot=np.arange(n))[["shard", "slot", "source_id", "pass", "block"]]
                    left, at, shard = left - drawn, at + drawn, shard + 1

    return spark.range(groups).repartition(min(groups, 10 * common.partitions(spark)), "id").mapInPandas(each, "shard long, slot long, source_id int, pass int, block long")


def packed(documents: DataFrame, p: Plan, keys: list[str]) -> DataFrame:
    """Each row of documents (keys, source, size) with source_id, source_size, target and at, where its words start
    among its source's. Offsets are summed in hash buckets, and over the buckets: no task gets a whole source."""
    spark = documents.sparkSession
    sources = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in p.rows], "source_id int, name string, source_size long, target double")
    rows = documents.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    count = 8 * common.partitions(spark)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(p.seed), *keys), F.lit(count)))
    sums = rows.groupBy("source_id", "bucket").agg(F.sum("size").alias("of_bucket"))
    before = Window.partitionBy("source_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_id", "bucket", F.coalesce(F.sum("of_bucket").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("source_id", "bucket").orderBy(*keys, "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return rows.join(sums, ["source_id", "bucket"]).withColumn("at", F.col("base") + F.col("within")).drop("bucket", "base", "within")


def segments(rows: DataFrame, p: Plan) -> DataFrame:
    """A row for each block that a row's words lie in: block, first (word of the row) and words."""
    n = F.lit(p.block_words)
    first, last = F.expr(f"at div {p.block_words}"), F.expr(f"(at + size - 1) div {p.block_words}")
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("block") * n, F.col("at"))
    return cut.withColumn("first", start - F.col("at")).withColumn("words", F.least((F.col("block") + 1) * n, F.col("at") + F.col("size")) - start)


def taken(documents: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 1) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the row in the mix, repeats counted) of each row.

    Null texts have size 0; a null source is a source of its own, last in order. Repeated rows count one by one. An
    empty table gives no rows. Other columns are not read.
    """
    rows = common.cut(documents.select("doc_id", "source", size_of(F.col("text")).alias("size")))  # words are counted once
    p = plan(rows, block_words, seed)
    placed = packed(rows, p, ["doc_id"])
    drawn = slots(documents.sparkSession, p).groupBy("source_id", "block").agg(F.count("*").alias("times"))
    key = ["source_id", "at", "doc_id", "source", "size", "source_size", "target"]
    some = segments(placed, p).join(drawn.hint("merge"), ["source_id", "block"], "left").groupBy(*key).agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken"))
    none = placed.where("size = 0").select(*key, F.lit(0).cast("long").alias("taken"))
    return some.unionByName(none).drop("source_id", "at")


def mixed(documents: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 1) -> DataFrame:
    """The mix as documents (doc_id, text, lang, source, n_chars): for each row and each pass over its source the words that
    the pass takes of it, with the white space that stood between them; a line break parts what wasn't adjacent.

    Rows of which nothing is taken go, so do null and empty texts and texts of white space: they have no words to take.
    Rows that repeat both id and text count once, other rows that share an id (or have none) are rows of their own. Long
    texts are cut into as many blocks as they need. Null sources and empty tables are handled as taken() does.
    """
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string"))
    slim = documents.select(key.alias("key"), "source", size_of(F.col("text")).alias("size"))
    slim = common.cut(slim.groupBy("key").agg(F.min("source").alias("source"), F.max("size").alias("size")))  # words are counted once
    p = plan(slim.select("source", "size"), block_words, seed)
    placed = packed(slim, p, ["key"])
    drawn = slots(documents.sparkSession, p).groupBy("source_id", "block", "pass").agg(F.count("*").alias("times"))
    pieces = segments(placed, p).join(drawn.hint("merge"), ["source_id", "block"]).groupBy("key", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("pieces"))
    pieces = pieces.groupBy("key").agg(F.collect_list("pieces").alias("passes"))
    texts = documents.select(key.alias("key"), "doc_id", "text", "lang", "source").join(pieces.hint("merge"), "key")
    # The join has dealt out and sorted by key: of rows that repeat id and text the window takes one without another shuffle.
    first = F.row_number().over(Window.partitionBy("key").orderBy("source", "lang"))
    texts = texts.withColumn("row", first).where("row = 1")
    words = F.regexp_extract_all("text", F.lit(rf"[{common.BLANK}]*[^{common.BLANK}]+[{common.BLANK}]*"), F.lit(0))
    out = texts.select("doc_id", words.alias("words"), "lang", "source", F.explode("passes").alias("pieces"))
    text_of = lambda x: F.array_join(F.slice("words", (x["first"] + 1).cast("int"), x["words"].cast("int")), "")
    goes_on = lambda x, i: (i == 0) | (F.get("pieces", i - 1)["first"] + F.get("pieces", i - 1)["words"] == x["first"])
    text = F.array_join(F.transform("pieces", lambda x, i: F.concat(F.when(goes_on(x, i), "").otherwise("\n"), text_of(x))), "")
    return out.select("doc_id", text.alias("text"), "lang", "source").select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
