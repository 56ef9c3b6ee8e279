"""Toxicity by class-conditional Kneser-Ney word models.

Two bigram models, one of the toxic and one of the ordinary labelled texts. A pair's occurrences, less a discount that
follows from the class's counts of counts (modified Kneser-Ney), back off to the class's continuation counts (after how
many words a word stands), and these to continuation counts that both classes share and that cover all documents.
What neither class has often enough is rare: it is left to the shared backoff, so it says the same under both models.
A text's evidence is the difference of its two length-normalised log-likelihoods, taken over its most toxic passage (the
whole text where it is shorter): a slur must not be diluted by the length of what surrounds it. A logistic fit of this
one number, on labelled texts that the counts have not seen, turns it into a probability.

Words are known by 64-bit hashes. One pass over the documents counts pairs in each task and hands them on packed, by
range of the word's hash; a second step merges the ranges.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm import cells, common

WORD = re.compile(r"\w+")
#: Labelled rows of the ordinary and of the toxic class that are held back from the counts for the calibration, at most: a
#: documented bound on the texts that reach the driver. A quarter of the labelled rows is held back where that is fewer.
MOST = (1125, 375)
#: An expression is rare if in neither class it stands in this share of the texts; the share that predicts held-back labels
#: best is used.
SHARES = (0.002, 0.005, 0.01, 0.015, 0.02, 0.03, 0.05)
#: It is also rare in fewer texts than this, and with a smaller share of all that its class has: no class has more than
#: 1 / MASS expressions that aren't rare, whatever its size, which bounds what reaches the driver and the tasks.
LEAST, MASS = 2, 5e-6
#: Words of a passage; 0: the whole text.
PASSAGES = (0, 32, 8, 3, 1)
#: Labels are sent to every task up to this number of rows, beyond it texts and labels meet in a shuffle.
LABELS_SENT = 2_000_000
#: Words that a task counts before it hands on what they hold.
AT_ONCE = 1_000_000
#: Ranges of hashes that are merged one by one, for each shuffle partition.
RANGES = 4
THRESHOLD = 0.3
CONTEXT = np.uint64((1 << 40) - 1)
#: Up to 2 to the power of this a word's number and its context fit in 64 bits, which are faster to sort.
NUMBER_BITS = 24
#: Pairs and words that are held before they are merged into what a range has so far.
HELD = 4_000_000
_DISCOUNT = 0.75


@dataclass
class Model:
    """Sorted hashes of the words, contexts (40 bits) and pairs that aren't rare, with the log-likelihood ratios of word, of
    backoff weight and of pair; other: of a rare word. passage: its number of words; weights: of the calibration."""

    words: np.ndarray
    unigram: np.ndarray
    other: float
    contexts: np.ndarray
    tail: np.ndarray
    pairs: np.ndarray
    ratios: np.ndarray
    weights: np.ndarray | None = None

    def ratios_of(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Of each word (by hash; a text's words from one of bounds to the next) the logarithm of its toxic likelihood over
        its ordinary one."""
        before = np.concatenate([np.zeros(1, np.uint64), ids[:-1]])[: len(ids)] & CONTEXT
        before[bounds[:-1][np.diff(bounds) > 0]] = 0
        out = _looked_up(self.words, self.unigram, ids, self.other) + _looked_up(self.contexts, self.tail, before, 0.0)
        return _looked_up(self.pairs, self.ratios, pair_of(before, ids), out)

    def word_ratios(self, text: str) -> np.ndarray:
        ids = hashes(WORD.findall(text.lower()))
        return self.ratios_of(ids, np.array([0, len(ids)]))

    def evidence(self, texts: list[str]) -> np.ndarray:
        """For each text and length of a passage the highest mean ratio of a passage."""
        out = np.zeros((len(texts), len(PASSAGES)))
        for s, e in common.runs_of([len(t) for t in texts], 1_000_000):
            ids = [hashes(WORD.findall(t.lower())) for t in texts[s:e]]
            bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            ratios = self.ratios_of(np.concatenate(ids), bounds)
            out[s:e] = np.column_stack([highest(ratios, bounds, p) for p in PASSAGES])
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        return common.logistic_apply(self.weights, self.evidence(texts))


def highest(ratios: np.ndarray, bounds: np.ndarray, passage: int) -> np.ndarray:
    """Of each text (from one of bounds to the next) the highest mean over so many neighbouring words; the mean of all where
    there are no more. No words: 0."""
    many = np.diff(bounds)
    total = np.concatenate([[0.0], np.cumsum(ratios)])
    out = (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(many, 1)
    if passage and (long := np.flatnonzero(many > passage)).size:
        means = np.append((total[passage:] - total[:-passage]) / passage, -np.inf)
        # A text's passages start at its first word, and at the last one from which there are so many words.
        ends = np.column_stack([bounds[:-1][long], bounds[1:][long] - passage + 1]).ravel()
        out[long] = np.maximum.reduceat(means, ends)[::2]
    return out


_known: dict[str, int] = common.MEMORY.setdefault("word hashes", {})


def hashes(words: list[str]) -> np.ndarray:
    if len(_known) > 200_000:
        _known.clear()
    for w in set(words).difference(_known):
        _known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def pair_of(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return common.mix64(before * np.uint64(0x9E3779B97F4A7C15) + common.mix64(word))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted)) + other
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], other)


@dataclass
class Tally:
    """Counts of labelled texts by class; an expression counts once in a text, as texts repeat their own words.

    words: sorted hashes; texts: in how many a word stands; followed: how many pairs start with it, a text's pairs
    counted once; pairs: how many different contexts a word has, which stand in before (40 bits, sorted within their
    word), n: in how many texts such a pair stands. Texts without a label add contexts alone. Hash 0 is the start of a
    text, which only precedes.
    """

    words: np.ndarray
    texts: np.ndarray
    followed: np.ndarray
    pairs: np.ndarray
    before: np.ndarray
    n: np.ndarray

    def slices(self, parts: int) -> Iterator[tuple[int, Tally]]:
        """The words of each of so many ranges of hashes that has any."""
        part = (self.words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        starts = cells.bounds(part) if len(part) else []
        at = np.concatenate([[0], np.cumsum(self.pairs)])
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            yield int(part[s]), Tally(self.words[s:e], self.texts[s:e], self.followed[s:e], self.pairs[s:e], self.before[at[s] : at[e]], self.n[at[s] : at[e]])

    def packed(self) -> bytes:
        """Byte by byte, so that like bytes stand together: differences of words, contexts, and counts."""
        parts = [_planes(np.diff(self.words, prepend=np.uint64(0)), 8), _planes(self.texts.ravel(), 4), _planes(self.followed.ravel(), 4), _planes(self.pairs, 4), _planes(self.before, 5), _planes(self.n.ravel(), 4)]
        return zstandard.ZstdCompressor(level=1).compress(np.array([len(self.words), len(self.before)], "<u8").tobytes() + b"".join(parts))

    @staticmethod
    def unpacked(b: bytes) -> Tally:
        raw = zstandard.ZstdDecompressor().decompress(b)
        words, pairs = np.frombuffer(raw, "<u8", 2).tolist()
        out, at = [], 16
        for size, width in ((words, 8), (2 * words, 4), (2 * words, 4), (words, 4), (pairs, 5), (2 * pairs, 4)):
            out.append(_numbers(raw[at : at + size * width], width))
            at += size * width
        count = lambda a: a.astype(np.int64).reshape(-1, 2)
        return Tally(np.cumsum(out[0], dtype=np.uint64), count(out[1]), count(out[2]), out[3].astype(np.int64), out[4], count(out[5]))


def _planes(a: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(a.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _numbers(b: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(b) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(b, np.uint8).reshape(width, -1).T
    return wide.view("<u8").ravel()


def _tallied(word: np.ndarray, before: np.ndarray, n: np.ndarray, of: np.ndarray, sums: np.ndarray) -> Tally:
    """Sums of equal pairs (word, before, n by class), and of equal words (of: the words; sums: texts and followed)."""
    words, index = np.unique(np.concatenate([of, word]), return_inverse=True)
    both = np.column_stack([np.bincount(index[: len(of)], weights=sums[:, k], minlength=len(words)) for k in range(4)]).astype(np.int64)
    index = index[len(of) :]
    if len(words) <= 1 << NUMBER_BITS:
        order = np.argsort((index.astype(np.uint64) << np.uint64(40)) | before)
    else:
        order = np.lexsort((before, index))
    index, before, n = index[order], before[order], n[order]
    del order
    new = np.ones(len(index), bool)
    new[1:] = (index[1:] != index[:-1]) | (before[1:] != before[:-1])
    starts = np.flatnonzero(new)
    n = np.add.reduceat(n, starts, axis=0, dtype=np.int64) if len(starts) else n.astype(np.int64)
    return Tally(words, both[:, :2], both[:, 2:], np.bincount(index[starts], minlength=len(words)), before[starts], n)


def tally(texts: list[str], labels: list[int | None]) -> Tally:
    """Counts of these texts; a label that isn't 0 or 1 is none."""
    code = np.array([v if v in (0, 1) else 2 for v in labels], np.int8)
    word, before, of, sums = [], [], [], []
    for t, k in zip(texts, code, strict=True):
        ids = hashes(WORD.findall(t.lower()))
        first = np.concatenate([np.zeros(min(1, len(ids)), np.uint64), ids[:-1]])
        once = np.unique(pair_of(first & CONTEXT, ids), return_index=True)[1]
        ids, first = ids[once], first[once]
        word.append(ids)
        before.append(first & CONTEXT)
        if k < 2:
            some, many = np.unique(first, return_counts=True)
            own = np.unique(ids)
            counts = np.zeros((len(own) + len(some), 4), np.int32)
            counts[: len(own), k] = 1
            counts[len(own) :, 2 + k] = many
            of += [own, some]
            sums.append(counts)
    label = np.repeat(code, [len(w) for w in word])

    def joined(parts: list[np.ndarray], empty: np.ndarray) -> np.ndarray:
        out = np.concatenate([empty, *parts])
        parts.clear()
        return out

    none = np.zeros(0, np.uint64)
    return _tallied(joined(word, none), joined(before, none), np.column_stack([label == k for k in (0, 1)]).astype(np.int8), joined(of, none), joined(sums, np.zeros((0, 4), np.int32)))


def merged(parts: list[Tally]) -> Tally:
    join = lambda name: np.concatenate([getattr(p, name) for p in parts])
    return _tallied(np.concatenate([np.repeat(p.words, p.pairs) for p in parts]), join("before"), join("n"), join("words"), np.column_stack([join("texts"), join("followed")]))


@dataclass
class Counts:
    """Of what isn't rare: words with numbers of texts and continuation counts by class, and continuation counts shared;
    contexts (40 bits) with their pairs by class, pairs (before, word) with numbers of texts by class. totals: sums over
    everything, by name. learnt: numbers of texts by class."""

    words: np.ndarray
    texts: np.ndarray
    of_word: np.ndarray
    shared: np.ndarray
    contexts: np.ndarray
    of_context: np.ndarray
    before: np.ndarray
    word: np.ndarray
    n: np.ndarray
    totals: dict[str, float]
    learnt: tuple[int, int]


#: Names of what is summed over all words and pairs, for both classes: pairs of texts, words of texts, continuation counts, and how
#: many pairs and words have a count of 1 to 4; then the shared contexts and words.
TOTALS = (*(f"{name}{k}" for name in ("pairs", "texts", "continuations", *(f"pairs_of_{r}_" for r in (1, 2, 3, 4)), *(f"words_of_{r}_" for r in (1, 2, 3, 4))) for k in (0, 1)), "contexts", "words")


def _summary(t: Tally) -> tuple[list[int], np.ndarray, np.ndarray]:
    """TOTALS of t, and of each word its continuation counts by class and shared."""
    has = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(t.n > 0, axis=0)])
    ends = np.cumsum(t.pairs)
    of_word = has[ends] - has[ends - t.pairs]
    many = lambda c: [int((c[:, k] == r).sum()) for r in (1, 2, 3, 4) for k in (0, 1)]
    return [*map(int, t.n.sum(0)), *map(int, t.texts.sum(0)), *map(int, of_word.sum(0)), *many(t.n), *many(of_word), int(t.pairs.sum()), int((t.pairs > 0).sum())], of_word, t.pairs


def discounts(counts_of_counts: list[float]) -> np.ndarray:
    """What modified Kneser-Ney takes from a count of 1, of 2 and of 3 or more, by how many have a count of 1 to 4."""
    n = np.array(counts_of_counts, float)
    out = np.full(4, _DISCOUNT)
    out[0] = 0.0
    if (n > 0).all():
        y = n[0] / (n[0] + 2 * n[1])
        out[1:] = [r + 1 - (r + 2) * y * n[r + 1] / n[r] for r in range(3)]
        out[1:] = np.clip(out[1:], 0.05, np.arange(1, 4) - 0.05)
    return out


def _over(counts: np.ndarray, cut: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Counts less their discount; nothing of what is rare."""
    return np.where(rare | (counts <= 0), 0.0, counts - cut[np.clip(counts, 0, 3)])


def count_model(c: Counts, share: float) -> Model:
    """The two models as tables of log-likelihood ratios, with what stands in less than this share of the texts as rare."""
    t = c.totals
    rare = lambda n, name: (n < [max(LEAST, share * c.learnt[k], MASS * t[f"{name}{k}"]) for k in (0, 1)]).all(1)
    rare_pair, rare_word = rare(c.n, "pairs"), rare(c.texts, "texts")
    shared = (c.shared + 1.0) / (t["contexts"] + t["words"] + 1)
    at = lambda keys, wanted: np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    v = at(c.contexts, c.before)
    w = at(c.words, c.word)
    over_word, over_pair = (
        np.column_stack([_over(n[:, k], discounts([t[f"{name}_of_{r}_{k}"] for r in (1, 2, 3, 4)]), rare) for k in (0, 1)])
        for n, name, rare in ((c.of_word, "words", rare_word), (c.n, "pairs", rare_pair))
    )
    # What the discounts and rare expressions leave is the backoff's weight, of both classes together: else the smaller
    # class, which leaves more, would have every rare expression on its side.
    weight = max(1 - over_word.sum() / max(t["continuations0"] + t["continuations1"], 1.0), 1e-9)
    of_context = np.column_stack([np.bincount(v, weights=over_pair[:, k], minlength=len(c.contexts)) for k in (0, 1)]) if len(v) else np.zeros((len(c.contexts), 2))
    left = np.maximum(1 - of_context.sum(1) / np.maximum(c.of_context.sum(1), 1), 1e-9)
    uni, tail, pair = [], [], []
    for k in (0, 1):
        p = (1 - weight) * over_word[:, k] / max(over_word[:, k].sum(), 1e-9) + weight * shared
        # A class that knows no pair of a context has its words there as anywhere.
        known = of_context[:, k] > 0
        rest = np.where(known, left, 1.0)
        uni.append(np.log(p))
        tail.append(np.log(rest))
        pair.append(np.log((1 - rest[v]) * over_pair[:, k] / np.maximum(of_context[v, k], 1e-9) + rest[v] * p[w]) if len(v) else np.zeros(0))
    kept = ~rare_pair
    keys = pair_of(c.before, c.word)[kept]
    order = np.argsort(keys)
    return Model(c.words[~rare_word], (uni[1] - uni[0])[~rare_word], 0.0, c.contexts, tail[1] - tail[0], keys[order], (pair[1] - pair[0])[kept][order])


def _calibrated(x: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit in which no evidence of toxicity speaks against it."""
    used = list(range(x.shape[1]))
    while True:
        w = common.logistic_fit(x[:, used], truth)
        if not used or w[:-1].min() >= 0:
            break
        del used[int(np.argmin(w[:-1]))]
    out = np.zeros(x.shape[1] + 1)
    out[[*used, -1]] = w
    return out


def _best(counts: Counts, rest: list[str], truth: np.ndarray) -> Model:
    best, least = None, np.inf
    for share in SHARES:
        model = count_model(counts, share)
        x = model.evidence(rest)
        model.weights = _calibrated(x, truth)
        p = common.logistic_apply(model.weights, x)
        loss = -np.log(np.where(truth == 1, p, 1 - p) + 1e-9).mean()
        if loss < least:
            best, least = model, loss
    return best


_FOUND = "kind int, word long, before long, " + ", ".join(f"{c} long" for c in "abcdefg")


def _packed_counts(rows: DataFrame, parts: int) -> DataFrame:
    """part and packed tallies of rows (text, label)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> Iterator[pa.RecordBatch]:
            for part, t in tally(texts, labels).slices(parts):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([t.packed()], pa.binary())], names=["part", "packed"])

        texts, labels, size = [], [], 0
        for batch in batches:
            for t, v in zip(common.texts_of(batch), batch.column("label").to_pylist(), strict=True):
                texts.append(t)
                labels.append(v)
                size += len(t)
                if size >= 6 * AT_ONCE:
                    yield from handed()
                    texts, labels, size = [], [], 0
        if texts:
            yield from handed()

    return common.arrow_batches(rows.select("text", "label"), "part int, packed binary", each)


def _merged_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[Tally]:
    """The tally of each range, from batches (part, packed) that are sorted by part. Tallies are merged as they come: what is
    held follows from the range's own words and pairs, not from how many tasks have counted them."""
    now, total, held, size = None, None, [], 0

    def all_of() -> Tally:
        return merged([*([total] if total is not None else []), *held])

    for batch in batches:
        for part, packed in zip(batch.column("part").to_pylist(), batch.column("packed"), strict=True):
            if part != now:
                if now is not None:
                    yield all_of()
                now, total, held, size = part, None, [], 0
            t = Tally.unpacked(packed.as_py())
            held.append(t)
            size += len(t.words) + len(t.before)
            if size > max(HELD, 2 * (len(total.words) + len(total.before)) if total is not None else 0):
                total, held, size = all_of(), [], 0
    if now is not None:
        yield all_of()


def counted(rows: DataFrame, learnt: tuple[int, int]) -> Counts:
    """Counts over all rows (text, label; null: shared only), of which so many have label 0 and 1."""
    spark = rows.sparkSession
    parts = RANGES * common.partitions(spark)

    def made_of(t: Tally) -> pa.RecordBatch:
        totals, of_word, shared = _summary(t)
        null = lambda n: np.zeros(n, np.int64)
        made = [[np.full(len(totals), 0), np.arange(len(totals)), null(len(totals)), np.array(totals), *[null(len(totals))] * 6]]
        some = np.flatnonzero((t.texts >= LEAST).any(1) | (t.followed >= LEAST).any(1))
        made.append([np.full(len(some), 1), t.words[some].view(np.int64), null(len(some)), *(x[some, k] for x in (t.texts, of_word, t.followed) for k in (0, 1)), shared[some]])
        some = np.flatnonzero((t.n >= LEAST).any(1))
        word = np.repeat(t.words, t.pairs)[some]
        made.append([np.full(len(some), 2), word.view(np.int64), t.before[some].view(np.int64), t.n[some, 0], t.n[some, 1], *[null(len(some))] * 5])
        columns = [np.concatenate(c) for c in zip(*made, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(columns[0].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in columns[1:])], names=[c.split()[0] for c in _FOUND.split(", ")])

    packed = _packed_counts(rows, parts).repartition(common.partitions(spark), "part").sortWithinPartitions("part")
    found = common.written(common.arrow_batches(packed, _FOUND, lambda batches: map(made_of, _merged_ranges(batches))), "toxicity-counts")
    sums = {r.word: r.s for r in found.where("kind = 0").groupBy("word").agg(F.sum("a").alias("s")).collect()}  # one row a name
    totals = {name: float(sums.get(i, 0)) for i, name in enumerate(TOTALS)}
    # Each of these has a share of what its class has: 4 / MASS rows at most.
    enough = lambda a, b, name: (F.col(a) >= MASS * totals[f"{name}0"]) | (F.col(b) >= MASS * totals[f"{name}1"])
    pairs = found.where(F.col("kind") == 2).where(enough("a", "b", "pairs")).select("before", "word", "a", "b").toArrow()
    words = found.where(F.col("kind") == 1).where(enough("a", "b", "texts") | enough("e", "f", "pairs")).select("word", *"abcdefg").toArrow()
    number = lambda t, *names: np.column_stack([t.column(c).to_numpy().astype(np.int64) for c in names])
    of = lambda t, c: number(t, c)[:, 0].view(np.uint64)
    return chosen(of(words, "word"), number(words, "a", "b"), number(words, "c", "d"), number(words, "g")[:, 0], number(words, "e", "f"), of(pairs, "before"), of(pairs, "word"), number(pairs, "a", "b"), totals, learnt)


def chosen(words: np.ndarray, texts: np.ndarray, of_word: np.ndarray, shared: np.ndarray, followed: np.ndarray, before: np.ndarray, word: np.ndarray, n: np.ndarray, totals: dict[str, float], learnt: tuple[int, int]) -> Counts:
    """Counts with tables sorted, of the pairs whose word and context are in the table of words."""
    order = np.argsort(words)
    words, texts, of_word, shared, followed = words[order], texts[order], of_word[order], shared[order], followed[order]
    order = np.argsort(words & CONTEXT, kind="stable")
    contexts, of_context = (words & CONTEXT)[order], followed[order]
    ok = np.isin(word, words) & np.isin(before, contexts)
    return Counts(words, texts, of_word, shared, contexts, of_context, before[ok], word[ok], n[ok], totals, learnt)


def fit(texts: list[str], labels: list[int]) -> Model | None:
    """A model of texts that are at hand: three quarters give the counts, shared ones too, the rest the calibration;
    without both classes in both there is no model."""
    y = np.array(labels)
    for_counts = np.arange(len(y)) % 4 != 3
    if len({*y[for_counts]}) < 2 or len({*y[~for_counts]}) < 2:
        return None
    t = tally([t for t, c in zip(texts, for_counts, strict=True) if c], [int(v) for v in y[for_counts]])
    totals, of_word, shared = _summary(t)
    learnt = tuple(int((y[for_counts] == k).sum()) for k in (0, 1))
    counts = chosen(t.words, t.texts, of_word, shared, t.followed, t.before, np.repeat(t.words, t.pairs), t.n, dict(zip(TOTALS, map(float, totals), strict=True)), learnt)
    return _best(counts, [t for t, c in zip(texts, for_counts, strict=True) if not c], y[~for_counts])


def fitted(documents: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST) -> Model | None:
    """A model whose counts cover all documents, with the labels of all labelled rows but those held back for the
    calibration: a quarter of each class, at most most[class], those with the smallest hash of their id. Without both
    classes in both there is no model."""
    chosen = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).where("label IN (0, 1) AND doc_id IS NOT NULL")
    # A row that has both labels has none.
    chosen = common.cut(chosen.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("also")).where("label = also").drop("also"))
    there = {r.label: r["count"] for r in chosen.groupBy("label").count().collect()}
    back = common.cut(common.least_by_hash(chosen, tuple(min(m, -(-there.get(k, 0) // 4)) for k, m in enumerate(most))))
    rest, truth = common.labelled_texts(documents, back)
    learnt = common.cut(chosen.join(F.broadcast(back), "doc_id", "left_anti"))  # as many rows as most at most
    sizes = {r.label: r["count"] for r in learnt.groupBy("label").count().collect()}
    if len({*truth}) < 2 or len(sizes) < 2:
        return None
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(learnt) if sum(sizes.values()) <= LABELS_SENT else learnt, "doc_id", "left")
    counts = counted(rows, (sizes[0], sizes[1]))
    return _best(counts, rest, np.array(truth)) if counts.totals["pairs0"] and counts.totals["pairs1"] else None


def score(documents: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST, threshold: float = THRESHOLD) -> DataFrame:
    """documents with score (0 to 1, higher: likelier toxic) and predicted (1 from the threshold on).

    labels holds doc_id and toxic of the rows to learn from; all are counted but at most most[class] of each class, which
    calibrate. Null and empty texts get the score of no evidence. Rows with a null label or id are ignored, a row that is
    labelled both 0 and 1 has no label, repeated labels count once, repeated documents each. Ties of the hash that
    chooses the calibration go by doc_id. With no model to fit (a class is missing, no documents) every score is 0. An
    empty table gives no rows. Columns of documents named score or predicted are replaced; others pass through.
    """
    model = fitted(documents, labels, most)
    kept = documents.drop("score", "predicted")

    def each(batch: pa.RecordBatch, model: Model | None) -> list[pa.Array]:
        texts = common.texts_of(batch)
        s = model.score(texts) if model else np.zeros(len(texts))
        return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

    return common.with_columns(kept, "score double, predicted int", each, model)
