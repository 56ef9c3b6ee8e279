"""Phrases whose words stand together more often than their parts would by chance, per language.

Texts are lower-cased (A-Z) and cut into pieces at punctuation and line ends, pieces into words. All phrases of one to
max_n words become rows (lang, phrase, f), one for each phrase of a chunk of texts, which Spark adds up by language and
phrase. As a phrase can't occur more often than a phrase inside it, lengths are counted one after the other: of n words
only those phrases become rows whose both parts of n - 1 words may be frequent. Those are looked up in a bitmap of hashed
phrases of a fixed size; a bit that two phrases share lets a rare phrase through to the count, which is exact.

All else is relational: counts of prefixes and suffixes are joined to each cut of a candidate, scores are exact quotients
of decimals, candidates inside equally frequent longer ones go in an anti-join with one-word extensions (whatever is inside
a longer phrase is inside one that is longer by a word and at least as frequent as that), and windows rank the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolith.llm import common

#: What ends a piece, beside its text's end: fixed. Words end there and at blanks and tabs.
ENDS = r"[.,;:!?\x0A-\x0D]"
#: What stands for an end among the words: it is in none.
END = "."
#: A task's chunks end with the batch that brings them to so many characters together.
CHUNK_CHARS = 28_000_000
#: Bits of the bitmap of phrases that may be frequent (8 MB), whatever the input.
BITS = 26
#: Bits of a row of the bitmap on its way: those of Spark's bitmap aggregate.
ROW_BITS = 32_768
#: What stands for a language that isn't given.
NO_LANG = "und"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: pa.Array) -> pa.Array:
    """The texts' words in order, with END at every end of a piece and of a text."""
    marked = pc.replace_substring_regex(pc.fill_null(texts, ""), pattern=ENDS, replacement=f" {END} ")
    return common.ascii_words(pc.binary_join_element_wise(marked, END, " "))[0]


def word_hashes(words: list[str], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def longer(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word."""
    return common.mix64(phrase * _FACTOR + word)


def _bit(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def has_bit(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bit(hashes, int(bitmap.size * 8).bit_length() - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Chunk:
    """Words of one language in order, and its phrases as rows (lang, phrase, f)."""

    def __init__(self, lang: str):
        self.lang, self.parts, self.chars = lang, [], 0

    def add(self, texts: pa.Array) -> None:
        self.parts.append(tokens(texts))
        self.chars += pc.sum(pc.binary_length(texts)).as_py() or 0

    def phrases(self, n: int, bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        """Those of n words whose both parts may be frequent. For n = 1 all words, and the empty phrase, which stands for
        every word."""
        encoded = pa.chunked_array(self.parts).dictionary_encode()
        self.parts.clear()
        words = encoded.chunk(0).dictionary
        ids = np.concatenate([c.indices.to_numpy() for c in encoded.chunks])
        del encoded
        end = pc.index(words, END).as_py()
        if n == 1:
            many = np.bincount(ids, minlength=len(words))
            others = np.flatnonzero(np.arange(len(words)) != end)
            yield from self.rows(pa.concat_arrays([pa.array([""]), words.take(pa.array(others))]), np.concatenate([[many[others].sum()], many[others]]))
            return
        at, strings = self.candidates(ids, words, end, n, bitmap), words
        if not len(at):
            return
        code = ids[at].astype(np.int64)
        for k in range(1, n):  # the phrases' first k + 1 words as strings, and which of them stands at each place
            key = code * len(words) + ids[at + k]
            key, code = np.unique(key, return_inverse=True) if k < n - 1 else np.unique(key, return_counts=True)
            strings = pc.binary_join_element_wise(strings.take(pa.array(key // len(words))), words.take(pa.array(key % len(words))), " ")
        yield from self.rows(strings, code)

    def candidates(self, ids: np.ndarray, words: pa.Array, end: int, n: int, bitmap: np.ndarray) -> np.ndarray:
        """Where a phrase of n words starts whose both parts of n - 1 words, and so on down, have their bits."""
        of = word_hashes(words.to_pylist(), self.lang)
        ok = has_bit(bitmap, of)
        ok[end] = False
        at = np.flatnonzero(ok[ids])
        hashes = of[ids[at]] if n > 2 else at
        for k in range(2, n + 1):
            both = np.flatnonzero(at[1:] == at[:-1] + 1)  # a part starts here and at the next word
            at = at[both]
            if k < n:
                hashes = longer(hashes[both], of[ids[at + k - 1]])
                may = has_bit(bitmap, hashes)
                at, hashes = at[may], hashes[may]
        return at

    def rows(self, phrases: pa.Array, many: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(phrases), 65_536):
            some = phrases.slice(k, 65_536)
            yield pa.RecordBatch.from_arrays([pa.array([self.lang] * len(some), pa.string()), some, pa.array(many[k : k + 65_536], pa.int64())], names=["lang", "phrase", "f"])


def counts(documents: DataFrame, n: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """lang, phrase and f for the phrases of n words, added up over all documents (lang and text)."""
    shared = documents.sparkSession.sparkContext.broadcast(bitmap)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Chunk] = {}
        for batch in batches:
            langs, texts = batch.column("lang"), batch.column("text")
            for lang in pc.unique(langs).to_pylist():
                held.setdefault(lang, Chunk(lang)).add(texts.filter(pc.equal(langs, lang)))
            while sum(c.chars for c in held.values()) >= CHUNK_CHARS:
                yield from held.pop(max(held, key=lambda x: held[x].chars)).phrases(n, shared.value)
        while held:
            yield from held.popitem()[1].phrases(n, shared.value)

    rows = common.arrow_batches(documents.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text"), "lang string, phrase string, f long", each)
    # A chunk gives a phrase once: adding up before the shuffle would only cost.
    return rows.repartition(F.col("lang"), F.col("phrase")).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bitmap_of(frequent: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for the hash of each phrase (lang, phrase) of frequent: 2 ** bits bits, made by Spark's bitmap aggregate."""

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.empty(batch.num_rows, np.uint64)
        for k, (lang, phrase) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True)):
            words = word_hashes(phrase.split(" "), lang)
            h = words[:1]
            for j in range(1, len(words)):
                h = longer(h, words[j : j + 1])
            out[k] = h[0]
        return pa.RecordBatch.from_arrays([pa.array(_bit(out, bits).astype(np.int64))], names=["bit"])

    places = common.arrow_map(frequent.select("lang", "phrase"), "bit long", hashed)
    rows = places.groupBy(F.expr(f"bit div {ROW_BITS}").alias("row")).agg(F.expr(f"bitmap_construct_agg(bit % {ROW_BITS})").alias("bits")).collect()
    out = np.zeros(max(2**bits, ROW_BITS) // 8, np.uint8)
    for r in rows:
        out[r.row * ROW_BITS // 8 :][: ROW_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return out[: 2**bits // 8]


def frequent_phrases(documents: DataFrame, max_n: int = 5, min_count: int = 100) -> DataFrame:
    """lang, size (words), phrase and f of all phrases of up to max_n words that occur min_count times or more; of size 0 the
    empty phrase, whose f is the number of all words of the language. A stored table."""
    bitmap, found = None, []
    for n in range(1, max_n + 1):
        rows = counts(documents, n, bitmap).where((F.col("f") >= min_count) | (F.col("phrase") == ""))
        size = F.when(F.col("phrase") == "", 0).otherwise(n)
        rows = common.written(rows.select("lang", size.alias("size"), "phrase", "f"), f"phrases-{n}")
        found.append(rows)
        if n < max_n:
            more = bitmap_of(rows.where("size > 0"))
            if not more.any():
                break
            bitmap = more if bitmap is None else bitmap | more
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return out


def _words(first: int | Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " ", -1), first, n), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n and score of every candidate: floor(1000 a n / (l r)) at its lowest cut. Exact while a is
    below 10 ** 15 and n below 10 ** 17."""
    parts = frequent.where("size > 0").select("lang", "phrase", "f")
    candidates = frequent.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", _words(1, F.col("k"))).withColumn("tail", _words(F.col("k") + 1, F.col("size") - F.col("k")))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cuts = cuts.join(frequent.where("size = 0").select("lang", F.col("f").alias("n")), "lang")
    exact = "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"
    lowest = cuts.withColumn("score", F.expr(exact)).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "size")).alias("best"))
    return lowest.select("lang", "phrase", *(F.col(f"best.{c}") for c in ("size", "a", "l", "r", "n", "score")))


def maximal(candidates: DataFrame, share: int = 100) -> DataFrame:
    """candidates (lang, phrase, size, a) without those that a longer one holds which occurs at least share % as often."""
    inner = F.explode(F.array(_words(1, F.col("size") - 1), _words(2, F.col("size") - 1)))
    wider = candidates.where("size > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("wider"))
    out, wider = candidates.alias("c"), wider.alias("w")
    on = (F.col("c.lang") == F.col("w.lang")) & (F.col("c.phrase") == F.col("w.phrase")) & (100 * F.col("wider") >= share * F.col("a"))
    return out.join(wider, on, "left_anti")


def best(scored_phrases: DataFrame, most: int) -> DataFrame:
    """Each language's first rows by score, then a (both descending), then phrase, with rank (from 1). Shares of a language
    are ranked first, so that none is sorted by one task as a whole."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = common.partitions(scored_phrases.sparkSession)
    rows = scored_phrases.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))).where(F.col("rank") <= most)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return rows.drop("_share")


def mined(documents: DataFrame, max_n: int = 5, min_count: int = 100, most: int = 2000, share: int = 100) -> DataFrame:
    """Per lang the most telling phrases of two to max_n words: lang, rank, phrase, a (its count), l and r (those of the parts
    at its lowest cut), n (all words of the language) and score.

    Null texts are empty, a null lang is "und", empty texts have no words, and very long ones are counted whole, as all that
    a task holds is the numbers of its chunk's words. Repeated rows count as often as they occur. Other columns, whatever
    their names, are not looked at; an empty table gives no rows. A language needs no minimum of rows.
    """
    frequent = frequent_phrases(documents.select("lang", "text"), max_n, min_count)
    kept = maximal(common.written(scored(frequent), "phrases-scored"), share)
    return best(kept, most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same in SQL, all phrases of up to five words counted as they stand.
MINED_SQL = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (
  SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM s, (SELECT unnest(range(1, 6)) AS size)
  WHERE i + size - 1 <= len(ws)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND f >= 100),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
j AS (
  SELECT k.lang, k.size, k.phrase, k.a, k.k, x.f AS l, y.f AS r, t.n,
    CAST((CAST(1000 AS HUGEINT) * k.a * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.ws[1:k.k], ' ')
    JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.ws[k.k + 1:], ' ')
    JOIN t ON t.lang = k.lang),
b AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
m AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size AND 100 * c.a >= 100 * b.a
      AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
WHERE rank <= 2000
"""
