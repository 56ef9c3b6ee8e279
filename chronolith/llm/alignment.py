"""How the tokens of two tokenizers lie against each other in every text.

Both tokenizers put a boundary wherever a space or a line feed follows something that isn't white space: a text falls into
units there, and its alignment is that of its units, one after the other. So each distinct unit is encoded and aligned once,
weighted by how often it occurs, and texts get the results back by their units' positions in a chunk.

The alignment is relational: tokens of distinct units are exploded with their positions, a window sums their lengths up to
where each ends, both sides are joined on unit and end, and the running count of common ends numbers the groups. Id pairs
that end together are counted over the corpus. Of two such tokens one ends the other, so there are fewer pairs than both
vocabularies have suffixes, whatever the corpus: that table is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from chronolith.llm import bpe, common

#: A unit: white space from a space or line feed on, what follows, and more of both while other white space follows.
UNIT = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
#: What the second tokenizer writes for a space: a text that holds it can't be told from one with spaces.
SPACE = "▁"
#: Distinct units that are encoded at once.
AT_ONCE = 20_000


@lru_cache(maxsize=2)
def first_tokenizer(path: str | None):
    """The byte-level tokenizer of the file, for which special tokens are ordinary text."""
    t = bpe.tokenizer.__wrapped__(path)
    t.encode_special_tokens = True
    return t


def second_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def second_tokenizer(path: str | None):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path or second_path())


@lru_cache(maxsize=2)
def second_pieces(path: str | None) -> tuple[bytes, ...]:
    """The bytes of each id of the second tokenizer."""
    t = second_tokenizer(path)
    shown = [t.id_to_piece(i) for i in range(t.vocab_size())]
    return tuple(bytes([int(p[3:5], 16)]) if t.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(shown))


@lru_cache(maxsize=2)
def separable(path: str | None) -> bool:
    """If no piece of the second tokenizer goes on with a space behind anything else, or holds a line feed: then no merge
    crosses the border of units."""
    t = second_tokenizer(path)
    shown = [t.id_to_piece(i) for i in range(t.vocab_size())]
    return not any("\n" in p or SPACE in p.lstrip(SPACE) for p in shown)


def units(text: str, path: str | None = None) -> list[str]:
    """Units of a space and the text; none if the text is empty or both sides could not agree on its bytes."""
    if not text or SPACE in text:
        return []
    return UNIT.findall(f" {text}") if separable(path) else [f" {text}"]


def encode_first(found: list[str], path: str | None = None) -> list[list[int]]:
    return [e.ids for e in first_tokenizer(path).encode_batch(found, add_special_tokens=False)]


def encode_second(found: list[str], path: str | None = None) -> list[list[int]]:
    """The tokenizer puts a space before what it encodes: units bring it along, or it is taken off again."""
    t = second_tokenizer(path)
    out = t.encode([u[1:] if u[0] == " " else u for u in found], num_threads=1)
    # It puts none before nothing: a space at a text's end is one by itself.
    return [([t.piece_to_id(SPACE)] if u == " " else ids) if u[0] == " " else ids[1:] for u, ids in zip(found, out, strict=True)]


def packed_counts(found: list[bytes], many: np.ndarray) -> bytes:
    first = bpe.packed_words(found)
    return len(first).to_bytes(4, "little") + first + many.astype("<i8").tobytes()


def unpacked_counts(b: bytes) -> tuple[list[bytes], list[int]]:
    end = 4 + int.from_bytes(b[:4], "little")
    return bpe.unpacked_words(b[4:end]), np.frombuffer(b, "<i8", offset=end).tolist()


TOKENS = "array<struct<id: int, len: int>>"


def distinct(lists: DataFrame, first: str | None, second: str | None, parts: int) -> DataFrame:
    """part, unit, n (its occurrences) and its tokens a and b with their lengths in bytes, of the chunks' lists (part, packed).
    A task holds the distinct units of one range, however many chunks have them."""

    def tokens(part: int, of: list[tuple[bytes, int]]) -> pa.RecordBatch:
        found = [u.decode() for u, _ in of]
        columns = [pa.array([part] * len(of), pa.int32()), pa.array(found, pa.string()), pa.array([n for _, n in of], pa.int64())]
        for ids, piece in ((encode_first(found, first), bpe.pieces(first)), (encode_second(found, second), second_pieces(second))):
            for (u, _), some in zip(of, ids, strict=True):
                if b"".join([piece[i] for i in some]) != u:
                    raise ValueError(f"the tokens of {u!r} do not hold its bytes")
            flat = np.fromiter((i for some in ids for i in some), np.int32)
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            size = np.fromiter(map(len, piece), np.int32)[flat]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(flat), pa.array(size)], names=["id", "len"])))
        return pa.RecordBatch.from_arrays(columns, names=["part", "unit", "n", "a", "b"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[bytes, int] = {}
        now = None

        def made() -> Iterator[pa.RecordBatch]:
            held = list(of.items())
            of.clear()
            for k in range(0, len(held), AT_ONCE):
                yield tokens(now, held[k : k + AT_ONCE])

        for batch in batches:
            for part, b in zip(batch.column("part").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if part != now:
                    yield from made()
                    now = part
                for u, n in zip(*unpacked_counts(b), strict=True):
                    of[u] = of.get(u, 0) + n
        yield from made()

    dealt = lists.select("part", "packed").repartition(parts, "part").sortWithinPartitions("part")
    rows = common.arrow_batches(dealt, f"part int, unit string, n long, a {TOKENS}, b {TOKENS}", each)
    return common.written(rows.withColumn("u", F.monotonically_increasing_id()), "align-units")


def _co_partitioned(spark, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What make returns, stored; a join on two columns may use a partitioning by the first alone."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        return common.written(make(), name)
    finally:
        spark.conf.set(key, before)


def aligned(table: DataFrame) -> DataFrame:
    """u, n_a, n_b, groups (a1,a2|b1;a3|b2,b3) and links (a, b of the tokens that end together) of rows u, a, b."""
    parts = common.partitions(table.sparkSession)

    def tokens(side: str) -> DataFrame:
        rows = table.select("u", F.posexplode(side).alias("pos", "t")).select("u", "pos", F.col("t.id").alias(side), F.col("t.len").alias("len"))
        up_to = Window.partitionBy("u").orderBy("pos")
        return rows.repartition(parts, "u").select("u", F.sum("len").over(up_to).alias("end"), side)

    both = tokens("a").join(tokens("b"), ["u", "end"], "full_outer")
    cut = F.col("a").isNotNull() & F.col("b").isNotNull()
    before = Window.partitionBy("u").orderBy("end").rowsBetween(Window.unboundedPreceding, -1)
    numbered = both.withColumn("g", F.coalesce(F.sum(cut.cast("int")).over(before), F.lit(0)))
    ids = lambda c: F.expr(f"array_join(transform(filter(tokens, t -> t.{c} IS NOT NULL), t -> t.{c}), ',')")
    groups = numbered.groupBy("u", "g").agg(F.sort_array(F.collect_list(F.struct("end", "a", "b"))).alias("tokens"))
    groups = groups.select("u", "g", F.concat(ids("a"), F.lit("|"), ids("b")).alias("shown"), F.expr("element_at(tokens, -1)").alias("last"), F.expr("size(filter(tokens, t -> t.a IS NOT NULL))").alias("n_a"), F.expr("size(filter(tokens, t -> t.b IS NOT NULL))").alias("n_b"))
    out = groups.groupBy("u").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sort_array(F.collect_list(F.struct("g", "shown", "last"))).alias("all"))
    return out.select("u", "n_a", "n_b", F.expr("array_join(all.shown, ';')").alias("groups"), F.expr("transform(all, x -> struct(x.last.a AS a, x.last.b AS b))").alias("links"))


def pair_counts(units_aligned: DataFrame) -> DataFrame:
    """a, b, count (links of the pair in the whole corpus) and best (if no other id has more with b) from rows n, links."""
    counts = units_aligned.select("n", F.explode("links").alias("l")).groupBy("l.a", "l.b").agg(F.sum("n").alias("count"))
    counts = common.written(counts, "align-pairs")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


#: What a chunk gets of each of its units beside the groups' text, and what a text gets of all of its units.
VALUES = ("n_a", "n_b", "n_groups", "n_best", "count_sum")
RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def handed_back(lists: DataFrame, by_unit: DataFrame, sums: DataFrame, parts: int) -> DataFrame:
    """chunk, part and packed for each of the chunks' lists: of each of its units, in order, the groups' text and VALUES, from
    rows by_unit (part, u, unit, n_a, n_b, groups) and sums (part, u, n_groups, n_best, count_sum)."""
    rows = sums.withColumn("kind", F.lit(0)).unionByName(by_unit.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    rows = rows.unionByName(lists.withColumn("kind", F.lit(2)), allowMissingColumns=True)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, numbers, of = None, {}, {}
        for batch in batches:
            out: list[tuple] = []
            columns = ("part", "kind", "u", "unit", "groups", "n_a", "n_b", "n_groups", "n_best", "count_sum", "chunk", "packed")
            for part, kind, u, unit, groups, n_a, n_b, n_groups, n_best, count_sum, chunk, packed in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if part != now:
                    now, numbers, of = part, {}, {}
                if kind == 0:
                    numbers[u] = (n_groups, n_best, count_sum)
                elif kind == 1:
                    of[unit.encode()] = (groups.encode(), n_a, n_b, *numbers.pop(u))
                else:
                    found = [of[w] for w in unpacked_counts(packed)[0]]
                    values = np.array([f[1:] for f in found], "<i8").reshape(-1, len(VALUES)).T
                    out.append((chunk, part, bpe._shut(len(found).to_bytes(4, "little") + values.tobytes() + b"\n".join([f[0] for f in found]))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.binary()), strict=True)], names=["chunk", "part", "packed"])

    dealt = rows.repartition(parts, "part").sortWithinPartitions("part", "kind")
    return common.arrow_batches(dealt, "chunk string, part int, packed binary", each)


def unpacked_results(b: bytes) -> tuple[list[bytes], np.ndarray]:
    raw = bpe._open(b)
    n = int.from_bytes(raw[:4], "little")
    end = 4 + 8 * len(VALUES) * n
    return raw[end:].split(b"\n"), np.frombuffer(raw[4:end], "<i8").reshape(len(VALUES), n).T


def compared(documents: DataFrame, first: str | None = None, second: str | None = None, keep_groups: bool = False) -> DataFrame:
    """documents but for text with n_a, n_b (tokens), n_groups, n_links, n_best, count_sum (long), groups_sha256 and, with
    keep_groups, groups: its text. first and second name the tokenizers' files.

    Null and empty texts, and those that hold U+2581, have no tokens: zeros and ''. Very long texts are a chunk of their own,
    in units; a text without spaces and line feeds is one unit. Repeated rows count and are returned as often as they occur,
    an empty table gives no rows. Columns of the names above are replaced, others pass through, whatever their names.
    """
    spark = documents.sparkSession
    parts = common.partitions(spark)
    added = StructType.fromDDL(RESULT + ", groups string" * keep_groups)
    kept = [c for c in documents.columns if c.lower() not in {"text", "groups", *(n.lower() for n in added.names)}]
    # Other columns travel as one, so that none of them can have a name that is used here.
    rows = documents.select(F.struct(*([F.col(f"`{c}`") for c in kept] or [F.lit(0)])).alias("row"), "text")
    corpus = common.written(bpe.split(rows, None, parts, lambda t: units(t, second), packed_counts), "align-split")
    lists = corpus.where("part >= 0").select("chunk", "part", "packed")
    table = distinct(lists, first, second, parts)
    by_unit = _co_partitioned(spark, lambda: aligned(table).join(table.select("u", "part", "unit", "n").repartition(parts, "u"), "u"), "align-aligned")
    pairs = pair_counts(by_unit)
    sums = by_unit.select("part", "u", F.explode("links").alias("l")).select("part", "u", "l.a", "l.b").join(F.broadcast(pairs), ["a", "b"])
    sums = sums.groupBy("part", "u").agg(F.count("*").alias("n_groups"), F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("count").alias("count_sum"))
    back = handed_back(lists, by_unit.drop("n", "links"), sums, parts)
    both = corpus.where("part IS NULL OR part < 0").unionByName(back, allowMissingColumns=True)
    both = both.repartition(parts, "chunk").sortWithinPartitions("chunk", F.col("part").asc_nulls_last(), "at")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, order, held, shown, values, places = None, None, [], None, None, []
        for batch in batches:
            keep, sums, digests, strings = [], [], [], []
            for k, (chunk, part, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("chunk", "part", "packed")), strict=True)):
                if chunk != now:
                    now, held, shown = chunk, [], None
                if part is not None:
                    if part < 0:
                        order = np.argsort(bpe._numbers(bpe._open(packed)), kind="stable")  # the units by part, as they were sent
                    else:
                        held.append(unpacked_results(packed))
                    continue
                if shown is None:  # the chunk's units are complete
                    values = np.zeros((len(order), len(VALUES)), np.int64)
                    shown = [b""] * len(order)
                    if held:
                        values[order] = np.concatenate([v for _, v in held])
                        for i, s in zip(order.tolist(), (s for some, _ in held for s in some), strict=True):
                            shown[i] = s
                    held = []
                if packed is not None:
                    places = bpe.unpacked_places(packed)[::-1]
                at = places.pop()
                sums.append(values[at].sum(0))
                joined = b";".join([shown[i] for i in at.tolist()])
                digests.append(hashlib.sha256(joined).hexdigest() if joined else "")
                if keep_groups:
                    strings.append(joined.decode())
                keep.append(k)
            if keep:
                n = np.array(sums, np.int64).reshape(-1, len(VALUES))
                columns = [pa.array(n[:, i]) for i in (0, 1, 2, 2, 3, 4)] + [pa.array(digests, pa.string())] + ([pa.array(strings, pa.string())] if keep_groups else [])
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(keep)), *columns], names=["row", *added.names])

    out = common.arrow_batches(both, StructType([StructField("row", rows.schema["row"].dataType), *added.fields]), each)
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *added.names)
