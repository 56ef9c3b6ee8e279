"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections, in DataFrame functions only.

A paragraph is a line; a section is a run of paragraphs that ends where a paragraph's hash says so, so an edit moves no
boundary but its own. The root hashes the sections, a section its paragraphs, a paragraph its text: equal roots mean
equal texts, and where roots differ the first differing section, and in it the first differing paragraph, locate the
edit. Below the paragraphs lie leaves, pieces of at most PIECE characters and what ends their sentence; a leaf holds its
length and which of its equals it is, so the likeness of two trees is the share of text that their leaves have in common.
A fingerprint is the whole tree: root, sections, paragraphs, leaves.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.llm import common

PIECE = 80
#: One paragraph in so many ends a section.
SECTION = 8
#: Buckets of the id order, for each shuffle partition.
SPREAD = 4


def paragraphs(text: Column) -> Column:
    """Hashes of the text's lines, in order."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.md5(p.cast("binary")))


def sections(hashes: Column) -> Column:
    """Hashes of the runs of paragraphs, in order, from the paragraphs' hashes."""
    last = F.size(hashes)
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | (F.conv(F.substring(F.element_at(hashes, i), 1, 4), 16, 10).cast("int") % SECTION == 0))
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    return F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: F.sha2(F.array_join(F.slice(hashes, r["a"] + 1, r["b"] - r["a"]), "").cast("binary"), 256))


def root(section_hashes: Column) -> Column:
    return F.sha2(F.array_join(section_hashes, "").cast("binary"), 256)


def pieces(text: Column) -> Column:
    """The text's pieces as numbers: 44 bits of hash, 16 of length (2 * PIECE at most), sorted."""
    found = F.regexp_extract_all(text, F.lit(rf"[^.!?\n]{{1,{PIECE}}}[.!?\n]{{0,{PIECE}}}|[.!?\n]{{1,{PIECE}}}"), F.lit(0))
    return F.array_sort(F.transform(found, lambda p: F.conv(F.substring(F.md5(p.cast("binary")), 1, 11), 16, 10).cast("long") * 65536 + F.length(p)))


def leaves(sorted_pieces: Column) -> Column:
    """Of sorted pieces the leaves: the first of equal pieces is itself, further ones hash their number too. All differ."""
    last = F.size(sorted_pieces)
    ends = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | (F.get(sorted_pieces, i - 1) != F.get(sorted_pieces, i)))
    ends = F.when(last > 0, ends).otherwise(F.expr("cast(array() as array<int>)"))
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))))
    other = lambda x, k: F.shiftrightunsigned(F.xxhash64(x, k), 20) * 65536 + x % 65536
    run = lambda r: F.transform(F.slice(sorted_pieces, r["a"] + 1, r["b"] - r["a"]), lambda x, k: F.when(k == 0, x).otherwise(other(x, k)))
    runs = F.filter(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: r["b"].isNotNull())
    return F.flatten(F.transform(runs, run))


def fingerprint(root_hash: Column, section_hashes: Column, paragraph_hashes: Column, leaf_set: Column) -> Column:
    """root:sections:paragraphs:leaves, the first in hexadecimal, the others as base 64 of 8 bytes each."""
    digits = lambda hashes: F.array_join(F.transform(hashes, lambda h: F.substring(h, 1, 16)), "")
    low = F.array_join(F.transform(leaf_set, lambda x: F.lpad(F.hex(x), 16, "0")), "")
    return F.concat_ws(":", root_hash, *(F.base64(F.unhex(d)) for d in (digits(section_hashes), digits(paragraph_hashes), low)))


def _weight(leaf_set: Column) -> Column:
    return F.aggregate(leaf_set, F.lit(0).cast("long"), lambda a, x: a + x % 65536)


def likeness(a: Column, b: Column) -> Column:
    """Twice the length of the common leaves over that of both; two empty texts are alike."""
    total = _weight(a) + _weight(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * _weight(F.array_intersect(a, b)) / total)


def _low(rows: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """rows with paragraphs (hashes in order) and leaves of a column of texts, under the prefix."""
    name = lambda c: f"{prefix}{c}"
    # Each level is a column of its own before the next one reads it: in one expression it would be made again for each read.
    rows = rows.withColumn(name("paragraphs"), paragraphs(F.col(text))).withColumn(name("pieces"), pieces(F.col(text)))
    return rows.withColumn(name("leaves"), leaves(F.col(name("pieces")))).drop(name("pieces"))


def _high(rows: DataFrame, prefix: str = "") -> DataFrame:
    """rows with sections (hashes in order) and root of paragraphs, under the prefix."""
    name = lambda c: f"{prefix}{c}"
    return rows.withColumn(name("sections"), sections(F.col(name("paragraphs")))).withColumn(name("root"), root(F.col(name("sections"))))


def tree(documents: DataFrame) -> DataFrame:
    """doc_id with root, sections and paragraphs (hashes in order) and leaves. Null texts count as empty; an empty text
    is one empty paragraph."""
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return _high(_low(rows, "text")).drop("text")


def first_difference(a: Column, b: Column) -> Column:
    """Index, from 0, of the first paragraph or section in which two lists of hashes differ; null where none does."""
    n = F.greatest(F.size(a), F.size(b))
    at = F.filter(F.sequence(F.lit(1), n), lambda i: ~F.get(a, i - 1).eqNullSafe(F.get(b, i - 1)))
    return F.get(at, F.lit(0)) - 1


@dataclass
class Ranges:
    """Ranges of the order (descending id, null last, then ascending hash of the text) of about equal size, each of which
    starts with rows that exist. ids: bounds, ascending; a range holds the ids up to its bound, from it downwards. starts:
    for an id (None: null) that fills several ranges, the hashes at which these start. Ids and hashes are without their
    lowest bits where these would get lost in a double, as which percentiles are computed; drop: how many of the ids."""

    ids: list[int]
    starts: dict[int | None, list[int]]
    drop: int = 0

    def counts(self) -> list[int]:
        """Of each bound, how many ranges its ids fill."""
        return [len(self.starts.get(i, [0])) for i in self.ids]

    def size(self) -> int:
        return sum(self.counts()) + len(self.starts.get(None, []))


#: Bits of a hash that a double can't hold.
LOW = 12


def _ranges(rows: DataFrame, buckets: int) -> Ranges:
    """rows: doc_id and hash."""
    shares = lambda n: "array(" + ",".join(f"{(i + 1) / n:.9f}D" for i in range(n)) + ")"
    accuracy = max(10_000, 20 * buckets)
    all_rows = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    drop = 0 if all_rows.low is None or max(abs(all_rows.low), abs(all_rows.high)) < 2**53 else LOW
    rows = rows.select(F.shiftright("doc_id", drop).alias("id"), F.shiftright("hash", LOW).alias("hash"))
    often = Counter(rows.agg(F.expr(f"percentile_approx(id, {shares(buckets)}, {accuracy}) q")).first().q or [])
    parts = {i: k for i, k in often.items() if k > 1 and not drop}  # without its low bits an id stands for several
    if all_rows.n > all_rows.known:
        parts[None] = -(-(all_rows.n - all_rows.known) * buckets // all_rows.n)
    starts = {}
    if parts:
        most = max(parts.values())
        some = rows.where(F.col("id").isNull() | F.col("id").isin([i for i in parts if i is not None]))
        for x in some.groupBy("id").agg(F.min("hash").alias("least"), F.expr(f"percentile_approx(hash, {shares(most)}, {accuracy}) q")).collect():  # as many rows as buckets at most
            k = parts[x.id]
            starts[x.id] = sorted({x.least, *(x.q[i * most // k - 1] for i in range(1, k))})
    return Ranges(sorted({*often, *([] if all_rows.high is None else [all_rows.high >> drop])}), starts, drop)


def with_next(documents: DataFrame, columns: list[str]) -> DataFrame:
    """documents with a struct next of columns: those of the next row by descending doc_id, after the last of the first.

    Null ids come last, equal ids in the order of their texts' hashes. Rows are dealt into ranges that start with rows that
    exist, an id with many rows (or none) into several; the rows that open a range are also sent to the range before it,
    so no task needs all rows.
    """
    rows = documents.withColumn("hash", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), "hash"]
    found = _ranges(rows.select("doc_id", "hash"), SPREAD * common.partitions(documents.sparkSession))
    rows = rows.withColumn("id", F.shiftright("doc_id", found.drop)).withColumn("high", F.shiftright("hash", LOW))
    longs = lambda values: F.expr(f"array({','.join(f'{v}L' for v in values)})") if values else F.expr("cast(array() as array<bigint>)")
    counts = found.counts()
    larger = list(itertools.accumulate(reversed(counts), initial=0))[-2::-1]  # of each bound, the ranges of larger ones
    step = math.isqrt(len(found.ids)) + 1
    below = lambda values: F.size(F.filter(values, lambda b: b < F.col("id")))
    rows = rows.withColumn("bound", below(longs(found.ids[step - 1 :: step])) * step)
    rows = rows.withColumn("bound", F.col("bound") + below(F.slice(longs(found.ids), F.col("bound") + 1, step)))
    base, many = F.get(longs(larger), F.col("bound")), F.get(longs(counts), F.col("bound"))
    number, opens = base + many - 1, F.get(longs(found.ids), F.col("bound")) == F.col("id")
    for i, starts in found.starts.items():
        own = F.col("id").isNull() if i is None else F.col("id") == i
        within = F.size(F.filter(longs(starts), lambda b: b <= F.col("high"))) - 1
        number = F.when(own, (F.lit(sum(counts)) if i is None else base) + within).otherwise(number)
        opens = F.when(own, F.array_contains(longs(starts), F.col("high"))).otherwise(opens)
    rows = rows.withColumn("range", number.cast("int")).withColumn("opens", opens).drop("bound", "id", "high")
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    also = F.struct(F.pmod(F.col("range") - 1, F.lit(max(1, found.size()))).alias("range"), F.lit(True).alias("guest"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("opens"), F.array(own, also)).otherwise(F.array(own)))).drop("range", "opens")
    w = Window.partitionBy("to.range").orderBy("to.guest", *order)
    return rows.withColumn("next", F.lead(F.struct(*columns)).over(w)).where("NOT to.guest").drop("to", "hash")


def compared(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row, with section
    and paragraph: the first, from 0, in which the trees of the text and the edited text differ (null: nowhere).

    The edited text is the row's own with its last floor(n_chars / 2) code points replaced by the first as many (or all)
    of the next row's, by descending doc_id; null ids come last, rows that share an id (or have none) follow the hash of
    their text. Null texts count as empty, long ones are taken whole; a single row is its own
    next. Repeated rows each give a row, an empty table gives none. Other columns are not read.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    # Paragraphs and leaves are made once for each text and sent on with it, to the next row text and leaves; the levels above
    # follow from the paragraphs.
    out = _high(with_next(_low(rows, "text"), ["text", "leaves"]))
    half = (F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("next.text"), F.lit(1), half))
    out = out.withColumn("next_leaves", F.col("next.leaves")).withColumn("edited", edited).drop("text", "next")
    out = _high(_low(out, "edited", "edited_"), "edited_")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("root"), F.col("sections"), F.col("paragraphs"), F.col("leaves")).alias("fingerprint"),
        fingerprint(F.col("edited_root"), F.col("edited_sections"), F.col("edited_paragraphs"), F.col("edited_leaves")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"),
        first_difference(F.col("sections"), F.col("edited_sections")).alias("section"),
        first_difference(F.col("paragraphs"), F.col("edited_paragraphs")).alias("paragraph"),
    )
