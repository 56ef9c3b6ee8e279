"""N-gram Jaccard join by a MinHash LSH forest.

Texts with the same words are one item. An item's signature is cut into trees; in each tree its label is a path of eight
hash values, so the sorted labels are a prefix trie. Items whose labels agree in the shortest prefix that any item needs
share a branch of the trie; a task sorts a branch by label and walks it from the leaves up. Prefixes are shortened level
by level, for each item until pairs at the least similarity that a set of its size can link with are found with the
target recall; at each level signatures discard what is far below the bound, and what is linked already isn't compared
again. What is linked falls into candidate groups, and within these every pair is verified exactly on the sets of
shingles. Large branches and groups are dealt into pairs of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolith.llm import cells, common, shingles
from chronolith.llm.components import components, local_roots

TENTHS = 8
TREES = 16
LEVELS = 8
RECALL = 0.999
#: Candidates whose signatures agree in fewer places than the bound by so many standard errors are far below it.
ERRORS = 4.5
#: Branches of a trie with more rows are walked one by one.
SMALL = 24


def depth(similarity: float, recall: float = RECALL, trees: int = TREES, levels: int = LEVELS) -> int:
    """The longest prefix by which a pair of this similarity meets in some tree with the recall; 1 at least."""
    for d in range(levels, 1, -1):
        if 1 - (1 - similarity**d) ** trees >= recall:
            return d
    return 1


def least_similarity(size: int, tenths: int) -> float:
    """The least Jaccard similarity of at least tenths / 10 that a set of this size can have with any set."""
    # Of a partner with k of its members and m others: k / (size + m).
    return min(k / (size + m) for k in range(-(-tenths * size // 10), size + 1) for m in {0, (10 * k - tenths * size) // tenths} if 10 * k >= tenths * (size + m))


@lru_cache(maxsize=8)
def depths(tenths: int, recall: float, trees: int) -> np.ndarray:
    """The shortest prefix that sets of 0, 1, 2 ... members need; the last entry holds for all that are larger."""
    return np.array([depth(least_similarity(n, tenths) if n else 1.0, recall, trees) for n in range(64)] + [depth(tenths / 10, recall, trees)], np.int8)


def _signed(documents: DataFrame, trees: int, tenths: int, recall: float) -> DataFrame:
    """doc_id, hash (of the text), item (a hash of the text's words; null without words), sig and depth."""
    need = depths(tenths, recall, trees)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, sigs, least = [], [], []
        for some in _chunks(common.texts_of(batch)):
            words = shingles.words_of(some)
            found, at = shingles.shingles(words)
            sig = shingles.minhash(found, at, trees * LEVELS)
            for k, (s, e) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                items.append(item_of(words.hashes[s:e]) if e > s else None)
                sigs.append(sig[k].tobytes())
                many = int(at[k + 1] - at[k])
                least.append(int(need[len(np.unique(found[at[k] : at[k + 1]])) if many < len(need) - 1 else -1]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("hash"), pa.array(items, pa.int64()), pa.array(sigs, pa.binary()), pa.array(least, pa.int8())], names=["doc_id", "hash", "item", "sig", "depth"])

    return common.arrow_map(_keyed(documents), "doc_id long, hash long, item long, sig binary, depth byte", each)


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")


def item_of(hashes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _chunks(texts: list[str], size: int = 1_000_000):
    at, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield texts[at:i]
            at, total = i, 0
        total += len(t)
    if texts:
        yield texts[at:]


def walked(cell: np.ndarray, label: np.ndarray, need: np.ndarray, item: np.ndarray, like: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of rows that the tries of the cells link: from full labels (a row of levels each) on, prefixes are shortened
    until each row's need, and rows that share one are linked where like says so, unless their items are already."""
    levels = label.shape[1]
    nodes, node = np.unique(item, return_inverse=True)
    root, left, right = np.arange(len(nodes)), [], []
    order = np.lexsort((*label.T[::-1], cell))
    for level in range(levels, int(need.min(initial=levels)) - 1, -1):
        some = order[need[order] <= level]  # whose prefixes are still this short or shorter
        if len(some) < 2:
            continue
        key = np.column_stack([cell[some].astype(np.int64), label[some, :level]])
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(some)]])
        met = [(some[i], some[j]) for i, j in cells.small_pairs(starts, SMALL)]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            if e - s > SMALL and len(np.unique(root[node[some[s:e]]])) > 1:
                # Whatever is like the first row is linked with it; only the rest is compared with all.
                run = some[s:e]
                near = like(np.full(len(run), run[0]), run)
                left.append(np.full(int(near.sum()), run[0]))
                right.append(run[near])
                met += [(np.full(len(run), r), run) for r in run[~near]]
        for i, j in met:
            other = root[node[i]] != root[node[j]]
            i, j = i[other], j[other]
            for k in range(0, len(i), 50_000):
                a, b = i[k : k + 50_000], j[k : k + 50_000]
                ok = like(a, b)
                left.append(a[ok])
                right.append(b[ok])
        if left:
            left, right = [np.concatenate(left)], [np.concatenate(right)]
            root = local_roots(len(nodes), node[left[0]], node[right[0]])
    none = np.zeros(0, np.int64)
    return (left[0], right[0]) if left else (none, none)


def candidate_groups(items: DataFrame, least: float, trees: int, levels: int, shortest: int) -> DataFrame:
    """id and root: groups of items (item, sig, depth) that share a prefix in one of the trees, with signatures that agree in
    at least that share of their places. shortest: the least depth of any."""
    prefix = lambda t: F.struct(F.lit(t).cast("short").alias("tree"), F.substring("sig", t * levels + 1, shortest).alias("prefix"))
    slim = items.select("item", F.explode(F.array(*(prefix(t) for t in range(trees)))).alias("x")).select("item", "x.tree", F.xxhash64("x.tree", "x.prefix").alias("bucket"))
    rows = cells.dealt(slim, "bucket", "item").select("item", "tree", "cell").join(items.select("item", "sig", "depth"), "item")

    def work(table: pa.Table) -> pa.RecordBatch | None:
        item, cell, tree, need = (table.column(c).to_numpy() for c in ("item", "cell", "tree", "depth"))
        sig = cells.binaries(table, "sig", np.uint8, trees * levels)
        label = np.take_along_axis(sig, tree.astype(np.int64)[:, None] * levels + np.arange(levels), 1)
        i, j = walked(cell, label, need, item, lambda a, b: (sig[a] == sig[b]).sum(1) >= least * trees * levels)
        if not len(i):
            return None
        a, b = cells.forest(item, i, j)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return components(cells.compared(rows, work, "a long, b long"))


def verified(sets: DataFrame, tenths: int) -> DataFrame:
    """a, b, links: for sets (item, n, group, shingles as packed numbers) of each group, with b null the number of rows of
    other items that item a is similar to, with b the edges of a forest of similar items."""
    slim = sets.select("item", "group")
    rows = cells.dealt(slim, "group", "item").join(sets.select("item", "n", "shingles"), "item")

    def work(table: pa.Table) -> pa.RecordBatch | None:
        item, cell, side, n = (table.column(c).to_numpy() for c in ("item", "cell", "side", "n"))
        packed = table.column("shingles").to_pylist()
        starts, left, right = cells.bounds(cell), [], []
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            found = [np.frombuffer(p, np.uint64) for p in packed[s:e]]
            sizes = np.array([len(x) for x in found])
            like = shingles.similar(shingles.joint_counts(found), sizes, tenths)
            if side[s] >= 0:
                like &= side[s:e, None] != side[None, s:e]
            i, j = np.nonzero(np.triu(like, 1))
            left.append(i + s)
            right.append(j + s)
        i, j = np.concatenate(left), np.concatenate(right)
        if not len(i):
            return None
        nodes, at = np.unique(np.concatenate([item[i], item[j]]), return_inverse=True)
        links = np.bincount(at, weights=np.concatenate([n[j], n[i]])).astype(np.int64)
        a, b = cells.forest(item, i, j)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([nodes, a])), pa.array([None] * len(nodes) + b.tolist(), pa.int64()), pa.array(np.concatenate([links, np.zeros(len(a), np.int64)]))], names=["a", "b", "links"])

    return cells.compared(rows, work, "a long, b long, links long", at_once=3000)


def _classes(documents: DataFrame, tenths: int, trees: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, hash and item of each row; and of each item root (of its class), class_id, others (links with other items),
    n (its rows) and one: whether it has an id, doc_id and hash of its first row."""
    similarity = tenths / 10
    signed = common.cut(_signed(documents, trees, tenths, recall))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("one")
    items = common.cut(signed.where("item IS NOT NULL").groupBy("item").agg(first, F.count("*").alias("n"), F.max("sig").alias("sig"), F.min("depth").alias("depth")))
    least = similarity - ERRORS * (similarity * (1 - similarity) / (trees * LEVELS)) ** 0.5
    groups = candidate_groups(items, least, trees, LEVELS, depth(similarity, recall, trees))
    wanted = common.cut(groups.withColumnRenamed("id", "item").join(items.select("item", "one", "n"), "item").select("item", "root", "n", "one.doc_id", "one.hash"))
    texts = _keyed(documents)
    texts = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.doc_id) & (texts.hash == wanted.hash)).select(texts.doc_id, texts.hash, "text", "item", "n", "root")
    # Rows that repeat both id and text stand for their item once.
    texts = texts.dropDuplicates(["doc_id", "hash"])

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        packed = [s.tobytes() for some in _chunks(common.texts_of(batch)) for s in shingles.distinct(*shingles.shingles(shingles.words_of(some)))]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("item", "n", "root")), pa.array(packed, pa.binary())], names=["item", "n", "group", "shingles"])

    sets = common.cut(common.arrow_map(texts.select("item", "n", "root", "text"), "item long, n long, group long, shingles binary", each))
    found = common.cut(verified(sets, tenths))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("item")).agg(F.sum("links").alias("others"))
    parts = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("id", "item")
    of_item = common.cut(items.select("item", "one", "n").join(links, "item", "left").join(parts, "item", "left").withColumn("root", F.coalesce("root", "item")))
    ids = common.cut(of_item.groupBy("root").agg(F.min("one.doc_id").alias("class_id")))
    return signed.select("doc_id", "hash", "item"), common.cut(of_item.join(ids, "root"))


def joined(documents: DataFrame, tenths: int = TENTHS, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id and n_links of each row of documents (doc_id, text).

    Two rows link when the Jaccard similarity of their sets of five-word shingles (case folded, white space alike; fewer
    words are one shingle) is at least tenths / 10; n_links counts the other rows that a row links with, copies
    included; class_id is the smallest doc_id that it reaches by links. Texts that are null, empty or without words link
    with nothing and are their own class; long texts are taken whole. Repeated rows, and rows that share an id, are rows
    of their own and link like others. Rows with a null doc_id link like others too; a class of them alone has a null
    class_id. An empty table gives no rows. Other columns are not read.
    """
    signed, found = _classes(documents, tenths, trees, recall)
    result = found.select("item", "class_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = signed.select("doc_id", "item").join(result, "item", "left")
    return out.select("doc_id", F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(documents: DataFrame, tenths: int = TENTHS, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """documents with one row of each class of joined(): the one with the smallest doc_id (null last), of such rows the one
    with the smallest hash of its text. Of rows that repeat both id and text one stays; texts without words all stay,
    but for such repeats. Different texts under one id are different documents. Other columns pass through, whatever their
    names."""
    signed, found = _classes(documents, tenths, trees, recall)
    first = found.groupBy("root").agg(F.min("one").alias("one")).select("one.doc_id", "one.hash")
    keys = common.cut(first.unionByName(signed.where("item IS NULL").select("doc_id", "hash").distinct()))
    id_, hash_, own, row = common.free(documents, "_id", "_hash", "_own", "_row")
    keys = keys.select(F.col("doc_id").alias(id_), F.col("hash").alias(hash_))
    rows = documents.withColumn(own, F.xxhash64("text"))
    rows = rows.join(keys, F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(hash_)))
    # The window sorts what the join has dealt out; nothing is shuffled again.
    comparable = [F.col(f"`{c}`") for c in documents.columns if c not in ("doc_id", "text") and documents.schema[c].dataType.typeName() not in ("map", "variant")]
    order = Window.partitionBy(id_, hash_).orderBy(*comparable, F.lit(0))
    return rows.withColumn(row, F.row_number().over(order)).where(F.col(row) == 1).drop(id_, hash_, own, row)
