"""Substring dedup: repeated passages, by paragraph MinHash banding and by anchors inside paragraphs.

Paragraphs (lines of PARAGRAPH_WORDS words or more) with the same words are one item. Items are banded by MinHash, the
number of rows a band holds chosen for the recall; what collides is verified on exact Jaccard similarity of its
five-word shingles. Passages also stand in the middle of paragraphs that are otherwise unlike; for these each text is
cut at windows of ANCHOR_WORDS words whose hash is the least around, so any run of PASSAGE_WORDS words that two texts
share holds a window that both select, and equal windows collide by hash, whatever surrounds them. From its first and
last window each run is extended word by word, as far as another text agrees. Spans that collide are the nodes of a
graph; its components are the passages, of which the first occurrence stays and the others go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolith.llm import common, jaccard, shingles
from chronolith.llm.components import components

PARAGRAPH_WORDS = 40
PASSAGE_WORDS = 50
ANCHOR_WORDS = 32
TENTHS = 8
HASHES = 48
RECALL = 0.995
ERRORS = 5.0


#: What tells texts apart.
TEXT = ["doc_id", "text_no"]


def _with_number(documents: DataFrame) -> DataFrame:
    """documents with text_no: 0 but where an id has several texts, which are numbered by their hashes."""
    named = documents.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash")).where("_id IS NOT NULL")
    several = named.groupBy("_id").agg(F.min("_hash").alias("a"), F.max("_hash").alias("b")).where("a <> b").select("_id")
    texts = common.cut(named.join(several, "_id").distinct().withColumn("_no", F.row_number().over(Window.partitionBy("_id").orderBy("_hash")) - 1))
    documents = documents.drop("text_no")
    if texts.isEmpty():
        return documents.withColumn("text_no", F.lit(0))
    id_, hash_, number, own = common.free(documents, "_id", "_hash", "_no", "_own")
    texts = texts.select(F.col("_id").alias(id_), F.col("_hash").alias(hash_), F.col("_no").alias(number))
    rows = documents.withColumn(own, F.xxhash64("text"))
    rows = rows.join(texts, (F.col("doc_id").cast("long") == F.col(id_)) & (F.col(own) == F.col(hash_)), "left")
    return rows.withColumn("text_no", F.coalesce(number, F.lit(0))).drop(id_, hash_, number, own)


def _numbered(documents: DataFrame) -> DataFrame:
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    return _with_number(texts)


def band_rows(similarity: float, recall: float = RECALL, hashes: int = HASHES) -> int:
    """The most rows a band can hold so that a pair of this similarity collides in some band with the recall."""
    for rows in range(hashes, 1, -1):
        if hashes % rows == 0 and 1 - (1 - similarity**rows) ** (hashes // rows) >= recall:
            return rows
    return 1


def selected(found: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """Indexes of the windows that are the least (the last of equals) of some span neighbouring windows of their text."""
    n = len(found)
    if not n:
        return np.zeros(0, np.int64)
    # Minimum over each span by doubling; equal hashes are told apart by position, the later being less.
    order = np.empty(n, np.int64)
    order[np.lexsort((-np.arange(n), found))] = np.arange(n)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    least, width = order.copy(), 1
    while width < span:
        step = min(width, span - width)
        least = np.concatenate([np.minimum(least[:-step], least[step:]), least[len(least) - step :]]) if n > step else least
        width += step
    ends = np.arange(n) + span - 1
    ok = (ends < n) & (owner[np.minimum(ends, n - 1)] == owner)
    chosen = np.zeros(n, bool)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    chosen[place[least[ok]]] = True
    for k in np.flatnonzero((np.diff(at) > 0) & (np.diff(at) < span)):  # texts with fewer windows than the span
        s, e = at[k], at[k + 1]
        chosen[s + int(np.argmin(order[s:e]))] = True
    return np.flatnonzero(chosen)


def _anchors(documents: DataFrame, anchor: int, passage: int) -> DataFrame:
    """window (hash), doc_id, text_no, place (which of the text's anchors), start and end in code points, of every anchor."""

    def each(batches):
        for batch in batches:
            ids, numbers, at_row = batch.column("doc_id"), batch.column("text_no"), 0
            for some in jaccard._chunks(common.texts_of(batch)):
                words = shingles.words_of(some, places=True)
                found, at = shingles.windows(words, anchor)
                chosen = selected(found, at, passage - anchor + 1)
                owner = np.searchsorted(at, chosen, "right") - 1
                first = words.bounds[owner] + chosen - at[owner]
                place = np.arange(len(chosen)) - np.searchsorted(owner, owner)
                rows = pa.array(owner + at_row)
                yield pa.RecordBatch.from_arrays([pa.array(found[chosen].view(np.int64)), ids.take(rows), numbers.take(rows), pa.array(place.astype(np.int32)), pa.array(words.start[first].astype(np.int32)), pa.array(words.end[first + anchor - 1].astype(np.int32))], names=["window", "doc_id", "text_no", "place", "start", "end"])
                at_row += len(some)

    return common.arrow_batches(documents, "window long, doc_id long, text_no int, place int, start int, end int", each)


#: Bytes of a word's hash beside an anchor, and distinct surroundings that a task gathers before it hands them on.
WORD_BYTES, GATHERED = 6, 100_000
_LEFT, _RIGHT = 0, 1


def _beside(documents: DataFrame, ends: DataFrame, anchor: int, most: int) -> DataFrame:
    """Words beside the anchors of ends, most of them at most, from the anchor outwards: window, side, words (WORD_BYTES of
    hash each); for a run's end node, doc_id, removed and places (how far so many words reach, in code points), and for
    all anchors that are an end of any run the least and the largest doc_id with these words, gathered in each task, as
    most anchors in copies of a passage stand beside the same words. Beyond a shared anchor two texts that agree on more
    words share another anchor."""
    pieces = ends.groupBy(*TEXT).agg(F.collect_list(F.struct(*(c for c in ends.columns if c not in TEXT))).alias("pieces"))
    texts = documents.join(pieces, TEXT).select("doc_id", "pieces", "text")
    schema = "window long, side int, words binary, node long, removed boolean, places array<int>, doc_id long, last long"

    def each(batches):
        def gathered():
            rows = [*at_ends, *((int.from_bytes(k[1:9], "little", signed=True), k[0], k[9:], None, None, None, least, last) for k, (least, last) in seen.items())]
            seen.clear(), at_ends.clear()
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        names = [c.split()[0] for c in schema.split(", ")]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.int64(), pa.int64()]
        seen: dict[bytes, tuple[int, int]] = {}
        at_ends: list[tuple] = []
        for batch in batches:
            pieces, docs, done = batch.column("pieces"), batch.column("doc_id"), 0
            for some in jaccard._chunks(common.texts_of(batch)):
                words = shingles.words_of(some, places=True)
                part = pieces.slice(done, len(some))
                p, owner = part.flatten(), np.repeat(np.arange(len(some)), part.value_lengths().to_numpy())
                ids = docs.slice(done, len(some)).take(pa.array(owner)).to_pylist()
                done += len(some)
                # Where each anchor stands among the words.
                wide = np.int64(max(map(len, some)) + 1)
                starts = words.owner() * wide + words.start
                index = np.searchsorted(starts, owner * wide + p.field("start").to_numpy())
                hashes = np.ascontiguousarray(words.hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
                window = p.field("window").to_numpy().astype("<i8")
                node, removed = p.field("node").to_pylist(), p.field("removed").to_pylist()
                for side, wanted, own in ((_LEFT, "lefts", "left"), (_RIGHT, "rights", "right")):
                    step, first = (-1, index - 1) if side == _LEFT else (1, index + anchor)
                    reach = words.start if side == _LEFT else words.end
                    is_end = p.field(own).to_numpy(zero_copy_only=False)
                    for k in np.flatnonzero(p.field(wanted).to_numpy(zero_copy_only=False)):
                        low, high = words.bounds[owner[k]], words.bounds[owner[k] + 1]
                        at = np.arange(first[k], max(first[k] - most, low - 1) if step < 0 else min(first[k] + most, high), step)
                        found = hashes[at].tobytes()
                        key = bytes((side,)) + window[k].tobytes() + found
                        least, last = seen.get(key, (ids[k], ids[k]))
                        seen[key] = (min(least, ids[k]), max(last, ids[k]))
                        if is_end[k]:
                            at_ends.append((int(window[k]), side, found, node[k], removed[k], reach[at].tolist(), ids[k], None))
                if len(seen) + len(at_ends) >= GATHERED:
                    yield gathered()
        if seen:
            yield gathered()

    return common.arrow_batches(texts, schema, each)


def _extended(documents: DataFrame, ends: DataFrame, anchor: int, most: int) -> DataFrame:
    """node, first and last: how far the runs go on beyond their anchors. A run that goes is extended by what an earlier
    document has, one that stays by what any other has."""
    beside = common.written(_beside(documents, ends, anchor, most), "beside")
    key = lambda: F.xxhash64("window", "side", F.expr(f"substring(words, 1, n * {WORD_BYTES})")).alias("key")

    def by_length(rows: DataFrame) -> DataFrame:
        rows = rows.where("length(words) > 0")
        return rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.expr(f"length(words) div {WORD_BYTES}").cast("int"))))

    known = beside.where("node IS NULL").groupBy("window", "side", "words").agg(F.min("doc_id").alias("least"), F.max("last").alias("last"))
    agreed = by_length(known).select(key(), "least", "last").groupBy("key").agg(F.min("least").alias("least"), F.max("last").alias("last")).where("least < last").select("key", "least")
    own = by_length(beside.where("node IS NOT NULL")).select("node", "doc_id", "removed", "side", F.get("places", F.col("n") - 1).alias("place"), key())
    reached = own.join(agreed, "key").where("NOT removed OR least < doc_id")
    return reached.groupBy("node").agg(F.min(F.when(F.col("side") == _LEFT, F.col("place"))).alias("first"), F.max(F.when(F.col("side") == _RIGHT, F.col("place"))).alias("last"))


def _paragraphs(documents: DataFrame, least: int, hashes: int) -> DataFrame:
    """doc_id, text_no, start, end, words, item (hash of the words) and sig of every paragraph with so many words."""

    def each(batches):
        for batch in batches:
            found = []
            for doc, number, t in zip(batch.column("doc_id").to_pylist(), batch.column("text_no").to_pylist(), common.texts_of(batch), strict=True):
                at = 0
                for line in t.split("\n"):
                    if len(line) >= 2 * least - 1:
                        found.append(((doc, number), at, line))
                    at += len(line) + 1
            done = 0
            for some in jaccard._chunks([f[2] for f in found]):
                words = shingles.words_of(some)
                sig = shingles.minhash(*shingles.shingles(words), hashes)
                rows = [(*found[done + k][0], found[done + k][1], found[done + k][1] + len(t), int(e - s), jaccard.item_of(words.hashes[s:e]), sig[k].tobytes()) for k, (t, s, e) in enumerate(zip(some, words.bounds[:-1], words.bounds[1:], strict=True)) if e - s >= least]
                done += len(some)
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "text_no", "start", "end", "words", "item", "sig"])

    return common.arrow_batches(documents, "doc_id long, text_no int, start int, end int, words int, item long, sig binary", each)


def _similar_paragraphs(documents: DataFrame, items: DataFrame, tenths: int, hashes: int, recall: float) -> DataFrame:
    """a and b: edges between similar items (item, doc_id, text_no, start, end of one occurrence, sig)."""
    similarity = tenths / 10
    rows = band_rows(similarity, recall, hashes)
    least = similarity - ERRORS * (similarity * (1 - similarity) / hashes) ** 0.5
    groups = jaccard.candidate_groups(items.withColumn("depth", F.lit(rows).cast("byte")), least, hashes // rows, rows, rows)
    wanted = common.cut(groups.withColumnRenamed("id", "item").join(items.drop("sig"), "item"))
    pieces = wanted.groupBy(*TEXT).agg(F.collect_list(F.struct("item", "root", "start", "end")).alias("pieces"))
    # Rows that repeat both id and text stand for their paragraphs once.
    texts = documents.join(pieces, TEXT).dropDuplicates(TEXT).select("pieces", "text")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, some, out = [], [], []
        for t, cuts in zip(common.texts_of(batch), batch.column("pieces").to_pylist(), strict=True):
            for p in cuts:
                keys.append(p)
                some.append(t[p["start"] : p["end"]])
        done = 0
        for part in jaccard._chunks(some):
            words = shingles.words_of(part)
            for k, s in enumerate(shingles.distinct(*shingles.shingles(words))):
                out.append((keys[done + k]["item"], 1, keys[done + k]["root"], s.tobytes()))
            done += len(part)
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["item", "n", "group", "shingles"])

    sets = common.cut(common.arrow_map(texts, "item long, n long, group long, shingles binary", each))
    return jaccard.verified(sets, tenths).where("b IS NOT NULL").select("a", "b")


def repeats(documents: DataFrame, tenths: int = TENTHS, hashes: int = HASHES, recall: float = RECALL, anchor: int = ANCHOR_WORDS, passage: int = PASSAGE_WORDS, paragraph: int = PARAGRAPH_WORDS) -> DataFrame:
    """One row for each span of a passage that repeats across documents: cluster_id, doc_id, text_no, start, end (code
    points, end exclusive), kept_doc_id (a document in which it stays) and removed.

    A passage repeats if a run of at least passage words is the same in several documents (runs from anchor words on may be
    found too; a span is all that agrees), or if a paragraph's Jaccard similarity to another document's is at least tenths / 10; case is folded.
    Of each run its first document, by doc_id, keeps it, of similar paragraphs the first of their component. Runs that
    share a window are one cluster, similar paragraphs another (equal paragraphs of passage words or more are runs). What repeats inside one
    document alone is left. Null, empty and short texts give no rows, long ones are taken whole. Rows with a null doc_id are not
    compared. Rows that share a doc_id are one document; where their texts differ, text_no tells which of them a span
    is of (from 0, by the texts' hashes; else 0). An empty table gives no rows. Other columns are not read.
    """
    texts = _numbered(documents)
    anchors = common.written(_anchors(texts, anchor, passage), "anchors")
    shared = common.cut(anchors.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most"))
    hits = anchors.join(shared, "window").withColumn("removed", F.col("doc_id") > F.col("least"))
    # Anchors that follow each other and share their fate are a run.
    order = Window.partitionBy(*TEXT).orderBy("place", "window")
    goes_on = (F.col("place") - F.lag("place").over(order) <= 1) & (F.col("removed") == F.lag("removed").over(order))
    hits = hits.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    hits = hits.withColumn("left", F.col("new") == 1).withColumn("right", F.coalesce(F.lead("new").over(order), F.lit(1)) == 1)
    hits = common.written(hits.select("window", *TEXT, "start", "end", "least", "removed", "left", "right", F.xxhash64(F.lit(1), *TEXT, "run").alias("node")), "hits")
    runs = hits.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("text_no").alias("text_no"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("least").alias("kept_doc_id"), F.first("removed").alias("removed"))
    hub = common.cut(hits.groupBy("window").agg(F.min("node").alias("a"), F.max("left").alias("lefts"), F.max("right").alias("rights")))
    edges = hits.select("window", F.col("node").alias("b")).join(hub, "window").select("a", "b").where("a <> b")
    ends = hits.join(hub.where("lefts OR rights").drop("a"), "window").select("window", *TEXT, "start", "removed", "left", "right", "lefts", "rights", "node")
    runs = runs.join(_extended(texts, ends, anchor, passage - anchor), "node", "left")
    runs = common.cut(runs.withColumn("start", F.least("start", "first")).withColumn("end", F.greatest("end", "last")).drop("first", "last"))

    lines = common.written(_paragraphs(texts, paragraph, hashes), "paragraphs")
    one = F.min(F.struct(*TEXT, "start", "end")).alias("one")
    items = common.cut(lines.groupBy("item").agg(one, F.max("doc_id").alias("most"), F.max("words").alias("words"), F.max("sig").alias("sig")).select("item", "one.*", "most", "words", "sig"))
    similar = common.cut(_similar_paragraphs(texts, items.drop("most", "words"), tenths, hashes, recall))
    node = lambda c: F.xxhash64(F.lit(2), c)
    # Runs and paragraphs are apart in this graph: one search for components serves both.
    parts = common.cut(components(edges.unionByName(similar.select(node("a").alias("a"), node("b").alias("b")))).withColumnRenamed("id", "node").withColumnRenamed("root", "cluster_id"))
    # Equal paragraphs of fewer words than a passage may share no anchor: they are a cluster even if nothing else is like them.
    alone = (F.col("doc_id") < F.col("most")) & (F.col("words") < passage)
    alike = items.select(node("item").alias("node"), "item", "doc_id", "most", alone.alias("alone")).join(parts, "node", "left")
    alike = alike.where("cluster_id IS NOT NULL OR alone").withColumn("cluster_id", F.coalesce("cluster_id", "node"))
    alike = common.cut(alike.select("item", "cluster_id", "doc_id", "most"))
    first = common.cut(alike.groupBy("cluster_id").agg(F.min("doc_id").alias("kept_doc_id"), F.max("most").alias("most")).where("kept_doc_id < most").drop("most"))
    used = common.cut(alike.select("item", "cluster_id").join(first, "cluster_id"))
    spans = lines.select("item", *TEXT, "start", "end").join(used, "item").withColumn("removed", F.col("doc_id") > F.col("kept_doc_id"))
    found = runs.join(parts, "node", "left").withColumn("cluster_id", F.coalesce("cluster_id", "node"))
    columns = ["cluster_id", "doc_id", F.col("text_no").cast("long").alias("text_no"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "kept_doc_id", "removed"]
    return found.select(*columns).unionByName(spans.select(*columns))


def without_repeats(documents: DataFrame, **options) -> DataFrame:
    """documents with the removed spans cut out of text. Rows without any stay as they are; other columns pass through,
    whatever their names, but for text_no."""
    gone = repeats(documents.select("doc_id", "text"), **options).where("removed").groupBy(*TEXT).agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    documents = documents.drop("text_no")
    id_, number, cuts_ = common.free(documents, "_id", "_no", "cuts")
    gone = gone.select(F.col("doc_id").alias(id_), F.col("text_no").alias(number), F.col("cuts").alias(cuts_))
    numbered = _with_number(documents)
    rows = numbered.join(gone, (F.col("doc_id").cast("long") == F.col(id_)) & (F.col("text_no") == F.col(number)), "left").drop(id_, number, "text_no")
    kept = documents.columns

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, cuts in zip(batch.column("text").to_pylist(), batch.column(cuts_).to_pylist(), strict=True):
            at, parts = 0, []
            for c in sorted(cuts or [], key=lambda c: c["start"]):
                parts.append((t or "")[at : c["start"]])
                at = max(at, c["end"])
            out.append("".join([*parts, t[at:]]) if parts else t)
        return pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else batch.column(c) for c in kept], names=kept)

    return common.arrow_map(rows.select(*(F.col(f"`{c}`") for c in kept), cuts_), documents.schema, each)
