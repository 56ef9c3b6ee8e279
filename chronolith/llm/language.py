"""Log-probabilities of whole texts under a gated recurrent language model.

Words of the training texts are counted in Spark. The most frequent ones are symbols of the network; of all others it sees
and predicts a class that follows from how the word is spelled (its last letters, and whether punctuation ends it). The
output softmax is factored: first the class, then, in classes of frequent words, the word. Inside a class of spellings
words have their share of the training counts, less an absolute discount that is left to words that training hasn't seen.
So a text's probability is that of its words and its end among all known words and the unknown one.

The network is trained on all training texts, once: in each of a few rounds every task takes the model as it is, trains on
its texts by truncated backpropagation and hands on what it got to; these are averaged by their numbers of tokens, block
by block, in Spark. Documents follow each other in lanes that are worked on side by side. A lane's state is carried from
window to window and forgotten where a text ends, in training as in scoring.

Words that aren't in the tasks' dictionary are joined to the table of counts afterwards.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronolith.llm import cells, common

#: Symbols of the network, classes that these are dealt into by frequency, width of the embeddings and of the state.
HEAD, CLASSES, EMBEDDING, STATE = 1024, 20, 16, 16
#: Classes of spellings: hashed last letters, with and without punctuation behind them.
SPELLINGS = 32
#: Words that go to every task with their counts, at most: the most frequent ones.
DICTIONARY = 131_072
#: Rounds of training; each takes its share of the texts.
ROUNDS = 4
#: Words of a window of training, its lanes, and its learning rate. There are fewer lanes where a chunk would have less than
#: so many windows. Texts are trained on in stretches of so many words.
WINDOW, TRAINED_LANES, RATE, WINDOWS, STRETCH = 32, 256, 0.1, 100, 2048
#: Lanes in scoring, and places of a window there: the fewer lanes are left, the longer it is.
SCORED_LANES, PLACES = 1024, 16_384
#: Characters of the texts that a task holds at once, a longer text excepted.
CHUNK_CHARS = 24_000_000
#: Numbers of a block in which models are averaged.
BLOCK = 8192
#: Counts are binned by their logarithm, so many bins to a factor of two.
BINS = 16

_MARKS = ".,;:!?\"')]}|"


def spellings(words: pa.Array) -> np.ndarray:
    """The class of each word, as spelling() has it."""
    bare = pc.utf8_rtrim(words, characters=_MARKS)
    last = pc.utf8_slice_codeunits(bare, start=-2).dictionary_encode()
    code = np.fromiter((zlib.crc32(x.encode()) for x in last.dictionary.to_pylist()), np.int64) % (SPELLINGS // 2)
    return code[last.indices.to_numpy()] + SPELLINGS // 2 * pc.not_equal(bare, words).to_numpy(zero_copy_only=False)


def spelling(word: Column) -> Column:
    bare = F.rtrim(word, F.lit(_MARKS))
    return (F.crc32(F.right(bare, F.lit(2)).cast("binary")) % (SPELLINGS // 2) + F.when(bare != word, SPELLINGS // 2).otherwise(0)).cast("int")


@dataclass
class Words:
    """What tasks know of words: the words (the first is the end, ""), their counts and spellings, and how many of them are
    symbols of the network; the ends of its classes, n and types of the training tokens; total, discount and types by
    spelling."""

    words: pa.Array
    counts: np.ndarray
    spellings: np.ndarray
    head: int
    ends: np.ndarray
    n: int
    types: int
    total: np.ndarray
    discount: np.ndarray
    kinds: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.n + self.types + 1))

    def share(self, counts: np.ndarray, spellings: np.ndarray) -> np.ndarray:
        """log10 of what a word with such a count (0: any unknown one) has of its class of spellings."""
        total, discount = self.total[spellings], self.discount[spellings]
        unseen = np.where(total > 0, discount * self.kinds[spellings], 1)
        return np.log10(np.where(counts > 0, counts - discount, unseen) / np.maximum(total, 1))


class Net:
    """The model's numbers: views of one flat array."""

    def __init__(self, words: Words, flat: np.ndarray | None = None):
        head, classes = words.head, len(words.ends)
        self.head, self.ends, self.classes = head, words.ends, classes
        self.class_of = np.concatenate([np.repeat(np.arange(classes), np.diff(words.ends, prepend=0)), classes + np.arange(SPELLINGS)]).astype(np.uint8)
        shapes = {"e": (head + SPELLINGS, EMBEDDING), "w": (EMBEDDING, 3 * STATE), "b": (3 * STATE,), "u": (STATE, 3 * STATE), "c": (STATE, classes + SPELLINGS), "cb": (classes + SPELLINGS,), "o": (head, STATE), "ob": (head,)}
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.flat = np.zeros(size, np.float32) if flat is None else flat.copy()
        self.views(shapes, self.flat, self.__dict__)
        self.shapes = shapes
        if flat is None:
            rng = np.random.default_rng(7)
            self.e[:] = rng.normal(0, 0.3, self.e.shape)
            self.w[:] = rng.normal(0, EMBEDDING**-0.5, self.w.shape)
            self.u[:] = rng.normal(0, 0.5 * STATE**-0.5, self.u.shape)
            self.b[:STATE] = 1  # states last
            mass = np.concatenate([np.add.reduceat(words.counts[:head], np.concatenate([[0], words.ends[:-1]])), words.total]) + 1.0
            self.cb[:] = np.log(mass / mass.sum())
            self.ob[:] = np.log(words.counts[:head] + 0.5)  # unigrams, until the network knows better

    @staticmethod
    def views(shapes: dict, flat: np.ndarray, into: dict) -> dict:
        at = 0
        for name, shape in shapes.items():
            size = int(np.prod(shape))
            into[name] = flat[at : at + size].reshape(shape)
            at += size
        return into

    def states(self, table: np.ndarray, before: np.ndarray, starts: np.ndarray, h: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States by step and lane, from h on; table has the inputs' gates. What backpropagation needs is put into keep."""
        steps, lanes, s = *before.shape, STATE
        out = np.empty((steps, lanes, s), np.float32)
        x, begins = table[before], starts.any(1).tolist()
        for t in range(steps):
            if begins[t]:
                h = h * ~starts[t][:, None]
            a = h @ self.u
            gate = a[:, : 2 * s] + x[t, :, : 2 * s]
            np.tanh(gate * np.float32(0.5), out=gate)
            gate *= np.float32(0.5)
            gate += np.float32(0.5)  # the logistic function
            z, r = gate[:, :s], gate[:, s:]
            n = np.tanh(x[t, :, 2 * s :] + r * a[:, 2 * s :])
            if keep is not None:
                keep["before"][t], keep["gate"][t], keep["n"][t], keep["a"][t] = h, gate, n, a[:, 2 * s :]
            h = n + z * (h - n)
            out[t] = h
        return out

    def table(self) -> np.ndarray:
        return self.e @ self.w + self.b

    def output(self, h: np.ndarray, symbol: np.ndarray, grad: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each symbol given its state, and with grad, to which it adds, the loss's slope in h."""
        kind = self.class_of[symbol]
        every = rows = np.arange(len(h))
        logits = h @ self.c
        logits += self.cb
        p, out = self.softmax(logits, rows, kind)
        dh = None
        if grad is not None:
            p[rows, kind] -= 1
            grad["c"] += h.T @ p
            grad["cb"] += _ONES[: len(p), 0] @ p
            dh = p @ self.c.T
        order = np.argsort(kind, kind="stable")
        bound = np.searchsorted(kind[order], np.arange(self.classes + 1)).tolist()
        first = 0
        for k, last in enumerate(self.ends.tolist()):
            at = order[bound[k] : bound[k + 1]]
            if len(at) and last - first > 1:
                mine, some, rows = h[at], symbol[at].astype(np.int64) - first, every[: len(at)]
                logits = mine @ self.o[first:last].T
                logits += self.ob[first:last]
                p, logs = self.softmax(logits, rows, some)
                out[at] += logs
                if grad is not None:
                    p[rows, some] -= 1
                    grad["o"][first:last] += p.T @ mine
                    grad["ob"][first:last] += _ONES[: len(p), 0] @ p
                    dh[at] += p @ self.o[first:last]
            first = last
        return out, dh

    @staticmethod
    def softmax(logits: np.ndarray, rows: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probabilities, in place of the logits, and the logarithms of the chosen ones."""
        np.minimum(logits, np.float32(80), out=logits)  # what would overflow; states and slopes keep them far below
        own = logits[rows, chosen]
        np.exp(logits, out=logits)
        total = logits @ _ONES[: logits.shape[1]]
        logits /= total
        return logits, own - np.log(total[:, 0])


_ONES = np.ones((1 << 16, 1), np.float32)


class Lanes:
    """Texts (symbols, and where each text begins, the end of all last) one after the other in so many lanes of about one length, the longest
    lane first. symbol, before (the symbol that the network sees there), start and text are by place."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray, lanes: int):
        sizes = np.diff(ends)
        loads = [(0, k) for k in range(max(1, min(lanes, len(sizes))))]
        lane = np.zeros(len(sizes), np.int64)
        for i in np.argsort(-sizes, kind="stable").tolist():
            load, k = loads[0]
            lane[i] = k
            heapq.heapreplace(loads, (load + int(sizes[i]), k))
        loads.sort(reverse=True)
        self.loads = np.array([n for n, _ in loads], np.int64)
        rank = np.empty(len(loads), np.int64)
        rank[[k for _, k in loads]] = np.arange(len(loads))
        order = np.argsort(rank[lane], kind="stable")  # of a lane the texts in their order
        self.offset = np.cumsum(self.loads) - self.loads
        self.text = np.repeat(order, sizes[order])
        self.symbol = symbols[np.arange(len(symbols)) + np.repeat(ends[order] - (np.cumsum(sizes[order]) - sizes[order]), sizes[order])]
        self.start = np.diff(self.text, prepend=-1) != 0
        self.before = np.where(self.start, 0, np.roll(self.symbol, 1)).astype(np.uint16)  # at first as behind an end

    def windows(self, places: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places by step and lane, of the lanes that there are still, and which of them hold a word. A window has WINDOW
        steps, or as many as make so many places."""
        longest, s = int(self.loads[0]), 0
        while s < longest:
            alive = int(np.searchsorted(-self.loads, -s, side="left"))
            step = np.arange(s, min(s + max(WINDOW, places // alive), longest))[:, None]
            loads = self.loads[:alive][None]
            yield self.offset[:alive][None] + np.minimum(step, loads - 1), step < loads
            s += len(step)


def stretches(ends: np.ndarray) -> np.ndarray:
    """ends, and those between the stretches of long texts."""
    sizes = np.diff(ends)
    parts = np.maximum(1, -(-sizes // STRETCH))
    within = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.append(np.repeat(ends[:-1], parts) + within * STRETCH, ends[-1])


def train(net: Net, slopes: np.ndarray, symbols: np.ndarray, ends: np.ndarray) -> None:
    """One pass over the texts; net and slopes (sums of squared gradients) change in place."""
    lanes = Lanes(symbols, stretches(ends), max(8, min(TRAINED_LANES, len(symbols) // (WINDOW * WINDOWS))))
    h = np.zeros((len(lanes.loads), STATE), np.float32)
    flat = np.zeros_like(net.flat)
    grad = Net.views(net.shapes, flat, {})
    for places, valid in lanes.windows():
        before, starts = lanes.before[places], lanes.start[places]
        keep = {k: np.empty((*before.shape, w), np.float32) for k, w in (("before", STATE), ("gate", 2 * STATE), ("n", STATE), ("a", STATE))}
        out = net.states(net.table(), before, starts, h[: places.shape[1]], keep)
        h = out[-1]
        flat[:] = 0
        dh = np.zeros_like(out)
        dh[valid] = net.output(out[valid], lanes.symbol[places[valid]], grad)[1]
        _backward(net, grad, keep, before, starts, dh)
        flat /= max(1, int(valid.sum()))
        slopes += flat * flat
        net.flat -= RATE * flat / (np.sqrt(slopes) + np.float32(1e-6))


def _backward(net: Net, grad: dict, keep: dict, before: np.ndarray, starts: np.ndarray, dh: np.ndarray) -> None:
    """Adds the slopes of the recurrent part, from those in the states of a window."""
    steps, lanes, s = dh.shape
    dx, da = np.empty((steps, lanes, 3 * s), np.float32), np.empty((steps, lanes, 3 * s), np.float32)
    back, begins = np.zeros((lanes, s), np.float32), starts.any(1).tolist()
    for t in range(steps - 1, -1, -1):
        back += dh[t]
        h, gate, n = keep["before"][t], keep["gate"][t], keep["n"][t]
        z, r = gate[:, :s], gate[:, s:]
        dn = back * (1 - z) * (1 - n * n)
        x = dx[t]
        x[:, :s], x[:, s : 2 * s], x[:, 2 * s :] = back * (h - n), dn * keep["a"][t], dn
        x[:, : 2 * s] *= gate * (1 - gate)
        da[t] = x
        da[t, :, 2 * s :] *= r
        back = back * z + da[t] @ net.u.T
        if begins[t]:
            back *= ~starts[t][:, None]
    dx, da = dx.reshape(-1, 3 * s), da.reshape(-1, 3 * s)
    symbols = before.ravel()
    grad["u"] += keep["before"].reshape(-1, s).T @ da
    grad["b"] += dx.sum(0)
    grad["w"] += net.e[symbols].T @ dx
    order = np.argsort(symbols, kind="stable")
    starts_at = cells.bounds(symbols[order])[:-1]
    grad["e"][symbols[order[starts_at]]] += np.add.reduceat((dx @ net.w.T)[order], starts_at, axis=0)


def log_probabilities(net: Net, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Natural log-probability of the symbols of each text."""
    lanes = Lanes(symbols, ends, SCORED_LANES)
    out, table = np.zeros(len(ends) - 1), net.table()
    h = np.zeros((len(lanes.loads), STATE), np.float32)
    for places, valid in lanes.windows(PLACES):
        states = net.states(table, lanes.before[places], lanes.start[places], h[: places.shape[1]])
        h, some = states[-1], places[valid]
        logs = net.output(states[valid], lanes.symbol[some])[0]
        np.add.at(out, lanes.text[some], logs)
    return out


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of some batches, with about as many characters of text as a chunk has."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if size >= CHUNK_CHARS:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def counted(texts: DataFrame) -> DataFrame:
    """word, c: how often it occurs in all of texts (text), and spelling. The end of a text is the word ''."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            many = pa.chunked_array([common.ascii_words(t)[0] for t in rows.column("text").chunks], pa.string()).value_counts()
            found = pa.table([many.field("values"), many.field("counts")], names=["word", "c"])
            yield from found.to_batches(65_536)
            yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([rows.num_rows], pa.int64())], names=["word", "c"])

    rows = common.arrow_batches(texts.select("text"), "word string, c long", each)
    # A chunk gives a word once: adding up before the shuffle would only cost.
    sums = rows.repartition("word").groupBy("word").agg(F.sum("c").alias("c"))
    return common.written(sums.select("word", "c", spelling(F.col("word")).alias("spelling")), "word-counts")


def known_words(counts: DataFrame, most: int = DICTIONARY, head: int = HEAD) -> tuple[Words, Column]:
    """What tasks get of the table of counts, at most so many words of it; and a condition that holds for the counts of the
    words that they get (the end excepted)."""
    level = F.floor(F.log2("c") * BINS)
    bins = sorted(((r.level, r.n) for r in counts.where("word <> ''").groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)
    sums = np.cumsum([n for _, n in bins])
    inside = int(np.searchsorted(sums, most, side="right"))
    least = bins[inside - 1][0] if inside else 1 << 30
    rows = sorted(((-r.c, r.word) for r in counts.where((level >= least) & (F.col("word") != "")).select("word", "c").collect()))
    found = pa.array(["", *(w for _, w in rows)], pa.string())
    kinds_of = spellings(found)
    totals = counts.agg(F.sum("c").alias("n"), F.count("*").alias("types"), F.sum(F.when(F.col("word") == "", F.col("c"))).alias("ends")).first()
    n = np.array([totals.ends or 0, *(-c for c, _ in rows)], np.int64)
    head = min(head, len(found))
    # The end is a class of its own; other symbols are dealt out by frequency, about as many occurrences to each class.
    mass = np.cumsum(n[1:head])
    band = np.minimum((mass - n[1:head]) * (CLASSES - 1) // max(1, int(mass[-1]) if len(mass) else 1), CLASSES - 2)
    ends = np.concatenate([[1], 1 + np.flatnonzero(np.append(np.diff(band) > 0, True)) + 1]) if len(band) else np.array([1])
    # What isn't a symbol, by spelling: all words less those that are.
    sums = np.zeros((4, SPELLINGS), np.int64)
    mine = F.col("word") != ""
    for r in counts.where(mine).groupBy("spelling").agg(F.sum("c").alias("n"), F.count("*").alias("types"), F.sum((F.col("c") == 1).cast("long")).alias("once"), F.sum((F.col("c") == 2).cast("long")).alias("twice")).collect():
        sums[:, r.spelling] = r.n, r.types, r.once, r.twice
    for kind, c in zip(kinds_of[1:head].tolist(), n[1:head].tolist(), strict=True):
        sums[:, kind] -= (c, 1, c == 1, c == 2)
    total, kinds, once, twice = sums
    discount = np.clip((once + 0.5) / (once + 2 * twice + 1), 0.05, 0.95)
    return Words(found, n, kinds_of, head, ends, int(totals.n or 0), int(totals.types or 0), total, discount, kinds), level >= least


class Reader:
    """Texts as numbers of their distinct words (tokens, and in ends where each text begins, the end of all last), and what
    is known of these words."""

    def __init__(self, words: Words, texts: pa.ChunkedArray):
        parts = [common.ascii_words(t) for t in texts.chunks]
        encoded = pa.chunked_array([p for p, _ in parts], pa.string()).dictionary_encode()
        own = encoded.chunk(0).dictionary if encoded.num_chunks else pa.array([], pa.string())
        first = np.cumsum([0, *map(len, texts.chunks)])
        text = np.concatenate([np.zeros(0, np.int64), *(at + k for (_, at), k in zip(parts, first, strict=False))])
        sizes = np.bincount(text, minlength=len(texts)) + 1
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.tokens = np.zeros(int(self.ends[-1]), np.int32)  # 0, the end, is the last of each text
        ids = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in encoded.chunks)])
        self.tokens[np.arange(len(text)) + text] = ids + 1
        self.words = pa.concat_arrays([pa.array([""]), own])
        known = pc.fill_null(pc.index_in(self.words, value_set=words.words), -1).to_numpy()
        self.spelling = np.where(known >= 0, words.spellings[known], 0)
        self.spelling[known < 0] = spellings(self.words.filter(pa.array(known < 0)))
        self.symbol = np.where((known >= 0) & (known < words.head), known, words.head + self.spelling).astype(np.uint16)
        self.known = known

    def symbols(self) -> np.ndarray:
        return self.symbol[self.tokens]


def trained(texts: DataFrame, words: Words, rounds: int = ROUNDS) -> np.ndarray:
    """The model's numbers, trained on all of texts (text, and round: which of the rounds takes it)."""
    spark = texts.sparkSession
    net = Net(words)
    state = np.concatenate([net.flat, np.full_like(net.flat, 1e-4)])
    dictionary = spark.sparkContext.broadcast(words)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(state)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, slopes, tokens = None, None, 0
            for rows in chunks(batches):
                if own is None:
                    half = len(shared.value) // 2  # noqa: B023
                    own, slopes = Net(dictionary.value, shared.value[:half]), shared.value[half:].copy()  # noqa: B023
                read = Reader(dictionary.value, rows.column("text"))
                tokens += len(read.tokens)
                train(own, slopes, read.symbols(), read.ends)
            if own is not None:
                both, task = np.concatenate([own.flat, slopes]).astype(np.float64) * tokens, TaskContext.get().partitionId()
                blocks = [both[i : i + BLOCK].tobytes() for i in range(0, len(both), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([task] * len(blocks), pa.int32()), pa.array([tokens] * len(blocks), pa.int64()), pa.array(blocks, pa.binary())], names=["block", "task", "tokens", "sums"])

        models = common.arrow_batches(texts.where(F.col("round") == k).select("text"), "block int, task int, tokens long, sums binary", each)
        found = _added(models).collect()
        if found:
            found.sort(key=lambda r: r.block)
            state = np.concatenate([np.frombuffer(r.sums) / r.tokens for r in found]).astype(np.float32)
        shared.unpersist()
    return state[: len(state) // 2]


def _added(models: DataFrame) -> DataFrame:
    """Of each block the sum over all tasks, in their order, one model at a time in memory."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tokens, total = None, 0, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["block", "tokens", "sums"])
        for batch in batches:
            for block, n, sums in zip(*(batch.column(c).to_pylist() for c in ("block", "tokens", "sums")), strict=True):
                if block != now:
                    if now is not None:
                        yield out()
                    now, tokens, total = block, 0, np.zeros(len(sums) // 8)
                tokens += n
                total += np.frombuffer(sums)
        if now is not None:
            yield out()

    dealt = models.repartition(common.partitions(models.sparkSession), "block").sortWithinPartitions("block", "task")
    return common.arrow_batches(dealt, "block int, tokens long, sums binary", each)


#: What scoring adds to a row: sums over the words of the dictionary and the network, and the other words with their numbers.
PARTIAL = "n_tokens long, n_known long, base_score double, score double, others array<struct<word: string, spelling: int, n: long>>"


def partial_scores(documents: DataFrame, words: Words, flat: np.ndarray) -> DataFrame:
    """documents but for text with PARTIAL."""
    shared = documents.sparkSession.sparkContext.broadcast((words, flat))
    names, added = [c for c in documents.columns if c != "text"], StructType.fromDDL(PARTIAL)
    schema = StructType([*(documents.schema[c] for c in names), *added.fields])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = shared.value
        net = Net(known, numbers)
        for rows in chunks(batches):
            read = Reader(known, rows.column("text"))
            inside = read.known >= 0
            c = np.where(inside, known.counts[read.known], 0)
            base = np.where(inside, known.base(c), 0)
            share = np.where(inside & (read.known >= known.head), known.share(c, read.spelling), 0)
            total = lambda x: np.add.reduceat(x[read.tokens], read.ends[:-1])  # noqa: B023, E731
            logs = np.log10(np.e) * log_probabilities(net, read.symbols(), read.ends) + total(share)
            # Of each text the words that this task doesn't know, each once with its number.
            at = np.flatnonzero(~inside[read.tokens])
            key, many = np.unique((np.searchsorted(read.ends, at, side="right") - 1) * len(read.words) + read.tokens[at], return_counts=True)
            word = key % len(read.words)
            others = pa.StructArray.from_arrays([read.words.take(pa.array(word)), pa.array(read.spelling[word], pa.int32()), pa.array(many, pa.int64())], names=["word", "spelling", "n"])
            ends = np.searchsorted(key, np.arange(rows.num_rows + 1) * len(read.words)).astype(np.int32)
            columns = [pa.array(np.diff(read.ends)), pa.array(total((c > 0).astype(np.int64))), pa.array(total(base)), pa.array(logs), pa.ListArray.from_arrays(pa.array(ends), others)]
            yield from pa.table([*rows.select(names).columns, *columns], names=[*names, *added.names]).to_batches(common.BATCH_ROWS)

    return common.arrow_batches(documents, schema, each)


def scored(documents: DataFrame, learned: Column) -> DataFrame:
    """documents but for text with n_tokens, n_known, train_tokens (long), base_score and score (double, log10); learned says
    which rows to learn from.

    Null and empty texts are their end alone; very long ones are read whole, in windows. Repeated rows count and are scored
    as often as they occur; where learned is null a row is not learned from. An empty table gives no rows, and without rows
    to learn from every word is unknown. Columns of the names above are replaced, others pass through.
    """
    kept = [c for c in documents.columns if c.lower() not in {"text", "n_tokens", "n_known", "train_tokens", "base_score", "score"}]
    # Other columns travel as one, so that none of them can have a name that is used here.
    rows = documents.select(F.struct(*([F.col(f"`{c}`") for c in kept] or [F.lit(0)])).alias("row"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    lessons = rows.where("learned").select("text", F.pmod(F.xxhash64("row", "text"), F.lit(ROUNDS)).alias("round"))
    counts = counted(lessons)
    words, dictionary = known_words(counts)
    flat = trained(lessons, words)
    parts = common.written(partial_scores(rows.select("row", "text"), words, flat).withColumn("at", F.monotonically_increasing_id()), "lm-scores")
    # Words that tasks don't know are looked up: those of the table of counts, and unknown ones.
    spread = documents.sparkSession.createDataFrame([(i, float(words.total[i]), float(words.discount[i]), float(words.kinds[i])) for i in range(SPELLINGS)], "spelling int, total double, discount double, kinds double")
    others = parts.select("at", F.explode("others").alias("o")).select("at", "o.word", "o.spelling", "o.n")
    others = others.join(counts.where(~dictionary & (F.col("word") != "")).select("word", "c"), "word", "left").join(F.broadcast(spread), "spelling")
    c = F.coalesce("c", F.lit(0))
    unseen = F.when(F.col("total") > 0, F.col("discount") * F.col("kinds")).otherwise(1.0)
    inside = F.log10(F.when(c > 0, c - F.col("discount")).otherwise(unseen) / F.greatest("total", F.lit(1.0)))
    base = F.log10((c + 1) / F.lit(float(words.n + words.types + 1)))
    sums = others.groupBy("at").agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * base).alias("base"), F.sum(F.col("n") * inside).alias("inside"))
    out = parts.drop("others").join(sums, "at", "left")
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return out.select(*[F.col("row").getField(name).alias(name) for name in kept], "n_tokens", plus("n_known", "more"), F.lit(words.n).cast("long").alias("train_tokens"), plus("base_score", "base"), plus("score", "inside"))
