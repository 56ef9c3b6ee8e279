"""Secret scans: fixed patterns, and a character convolutional network over every other candidate and its context.

Candidates are all runs of 16 or more key characters, but for what a pattern has found in them. The network (one-hot characters, one
convolution, maximum and mean over positions, one logistic unit) is written in numpy; long candidates are seen through
overlapping windows, the likeliest of which counts. It is trained on labelled findings:
what the patterns find in a bounded sample of texts, generated keys of common shapes in contexts of that sample, and
as negatives long words, links, dates, paths and numbers. Held-back findings calibrate it and set the threshold: the
highest that keeps the required recall.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolith.llm import common

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
KINDS = ("assign", "access", "hex", "model")
ORDER = {k: i for i, k in enumerate(KINDS)}
STEMS = ("passw", "secret", "token", "api")

#: Documented bounds of the training: texts that the network learns from, at most, with and without a word that a pattern
#: starts with; texts that are looked through for them, for each of these; findings and other long words of one text;
#: generated keys, and as many strings that look like them.
SAMPLE, SCREENED, FINDINGS, OTHERS, GENERATED = 600, 40, 20, 3, 900
RECALL = 0.98
LEFT, BODY, RIGHT, WIDTH, FILTERS, CODES = 16, 48, 16, 5, 24, 129
#: How far the windows of a long candidate are apart.
STEP = 16


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns' matches, leftmost and not overlapping within a kind; those too short are dropped."""
    found = []
    low = text.lower()
    if any(s in low for s in STEMS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    for run in CANDIDATE.finditer(text):  # every hex run of 32 lies in one of these
        if run.end() - run.start() >= 32:
            found += [("hex", m.start(), m.end()) for m in HEX.finditer(text, run.start(), run.end()) if m.end() - m.start() >= 32]
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Runs that may be secrets; of a run in which spans are taken, the parts beside these that are long enough."""
    ends = np.maximum.accumulate([e for _, _, e in taken]) if taken else []
    starts = [s for _, s, _ in taken]
    out = []
    for m in CANDIDATE.finditer(text):
        at, until = m.span()
        k = bisect_right(ends, at) if taken else 0
        while k < len(starts) and starts[k] < until:
            if starts[k] - at >= LEAST:
                out.append((at, starts[k]))
            at = max(at, int(ends[k]))
            k += 1
        if until - at >= LEAST:
            out.append((at, until))
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the left context, the candidate or a piece of it (BODY characters at most) and the right context."""
    s = text[max(0, start - LEFT) : start].rjust(LEFT, "\0") + text[start:end].ljust(BODY, "\0") + text[end : end + RIGHT].ljust(RIGHT, "\0")
    return np.array([ord(c) if ord(c) < 128 else 128 for c in s], dtype=np.int64)


def windows(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """Overlapping windows that together cover the whole of a candidate; one where it is short."""
    last = max(start, end - BODY)
    for s in (*range(start, last, STEP), last):
        yield window(text, s, min(s + BODY, end))


class Network:
    """Probability that a window shows a secret."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.conv = rng.normal(0, 0.2, (WIDTH, CODES, FILTERS))
        self.bias = np.zeros(FILTERS)
        self.out = rng.normal(0, 0.1, 2 * FILTERS)
        self.shift, self.scale, self.offset, self.threshold = 0.0, 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray) -> tuple:
        steps = x.shape[1] - WIDTH + 1
        a = sum(self.conv[k, x[:, k : k + steps]] for k in range(WIDTH)) + self.bias
        a = np.maximum(a, 0)
        at = a.argmax(axis=1)
        pooled = np.concatenate([a.max(axis=1), a.mean(axis=1)], axis=1)
        return a, at, pooled, pooled @ self.out + self.shift

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 0.02, size: int = 32, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        parts = ("conv", "bias", "out")
        state = {p: [np.zeros_like(getattr(self, p)), np.zeros_like(getattr(self, p))] for p in parts}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), size):
                xb, yb = x[order[i : i + size]], y[order[i : i + size]]
                a, at, pooled, z = self._forward(xb)
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - yb) / len(yb)
                steps = a.shape[1]
                up = np.outer(g, self.out)
                d = np.repeat(up[:, None, FILTERS:] / steps, steps, axis=1)
                np.put_along_axis(d, at[:, None, :], np.take_along_axis(d, at[:, None, :], 1) + up[:, None, :FILTERS], 1)
                d *= a > 0
                conv = np.zeros_like(self.conv)
                for k in range(WIDTH):
                    np.add.at(conv[k], xb[:, k : k + steps], d)
                t += 1
                for p, grad in zip(parts, (conv, d.sum((0, 1)), pooled.T @ g), strict=True):
                    m, v = state[p]
                    m += 0.1 * (grad - m)
                    v += 0.01 * (grad**2 - v)
                    getattr(self, p)[...] -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
                self.shift -= rate * g.sum()

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        """Fits probabilities to held-back findings, and the highest threshold that keeps the recall."""
        z = self._forward(x)[3]
        self.scale, self.offset = common.logistic_fit(z[:, None], y, ridge=1e-4)
        p = np.sort(self.probability(x)[y == 1])
        self.threshold = float(p[int((1 - recall) * len(p))]) if len(p) else 0.5
        self.recall = float((p >= self.threshold).mean()) if len(p) else 1.0

    def highest(self, text: str, spans: list[tuple[int, int]], size: int = 1024) -> np.ndarray:
        """Of each candidate the highest probability among its windows; size windows are scored at a time."""
        out, some, owner = np.zeros(len(spans)), [], []

        def flush() -> None:
            if some:
                np.maximum.at(out, owner, self.probability(np.array(some)))
            some.clear(), owner.clear()

        for i, (start, end) in enumerate(spans):
            for w in windows(text, start, end):
                some.append(w)
                owner.append(i)
                if len(some) == size:
                    flush()
        flush()
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self._forward(x)[3] + self.offset, -30, 30)))


def _shapes(rng: np.random.Generator, n: int) -> tuple[list[str], list[str]]:
    """n generated keys of common shapes, and n strings that look a little like them."""

    def draw(alphabet: str, size: int) -> str:
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), size))

    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = lower + lower.upper() + digits
    keys, others = [], []
    for i in range(n):
        size = int(rng.integers(18, 60))
        keys.append((draw(every + "+/", size), draw("0123456789abcdef", int(rng.integers(18, 32))), draw(every + "_-", size), "sk-" + draw(every, size), "ghp_" + draw(every, 36), ".".join(draw(every + "_-", int(k)) for k in rng.integers(18, 40, 3)))[i % 6])
        word = draw(lower, int(rng.integers(4, 12)))
        others.append((f"{draw(lower, 6)}.example/{word}/{draw(digits, 4)}/{draw(lower, 8)}", f"20{draw(digits, 2)}-0{1 + i % 9}-1{i % 10}-{word}-{draw(lower, 6)}", draw(digits, int(rng.integers(16, 24))), f"{word}_{draw(lower, 9)}_{draw(digits, 2)}", f"{word}{draw(lower, 14)}{draw(digits, 1)}", f"{draw(digits, 3)}-{draw(digits, 3)}-{draw(digits, 4)}.{word}.{word}")[i % 6])
    return keys, others


def train(texts: list[str], recall: float = RECALL, seed: int = 5) -> Network:
    """A network from labelled findings in texts; with no findings the generated ones alone."""
    rng = np.random.default_rng(seed)
    good, bad = [], []
    for t in texts:
        spans = base_spans(t)
        for kind, start, end in spans[:FINDINGS]:
            m = ASSIGN.match(t, start, end) if kind == "assign" else None
            good += windows(t, m.start(2) if m else start, end)
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]{12,}", t)]
        clear = [w for w in words if all(w[1] <= s or w[0] >= e for _, s, e in spans)]
        bad += [w for i in rng.permutation(len(clear))[:OTHERS] for w in windows(t, *clear[i])]
    hosts = [t for t in texts if len(t) > 200] or ["a b " * 100]
    keys, others = _shapes(rng, GENERATED)
    for made, into in ((keys, good), (others, bad)):
        for i, s in enumerate(made):
            host = hosts[i % len(hosts)]
            k = int(rng.integers(50, len(host) - 50))
            around = f"{host[k - 20 : k]} {s} {host[k : k + 20]}"
            into += windows(around, 21 if k >= 20 else k + 1, (21 if k >= 20 else k + 1) + len(s))
    x, y = np.array(good + bad), np.array([1.0] * len(good) + [0.0] * len(bad))
    fold = np.arange(len(y)) % 4 == 3
    net = Network()
    net.train(x[~fold], y[~fold])
    net.calibrate(x[fold], y[fold], recall)
    return net


def all_spans(text: str, net: Network) -> list[tuple[str, int, int]]:
    base = base_spans(text)
    if more := candidates(text, base):
        p = net.highest(text, more)
        base = sorted([*base, *(("model", s, e) for (s, e), q in zip(more, p, strict=True) if q >= net.threshold)], key=lambda s: (s[1], ORDER[s[0]]))
    return base


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def fitted(documents: DataFrame, sample: int = SAMPLE, screened: int = SCREENED) -> Network:
    """A network trained on at most 2 * sample texts, with and without a word that a pattern starts with: those with the
    smallest hash of their id among sample * screened texts, which are themselves chosen so. Of rows that share an id
    the text with the smallest hash is looked at; rows without an id aren't."""
    order = [F.xxhash64(F.lit(3), "doc_id"), "doc_id"]
    ids = common.cut(documents.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(*order).limit(sample * screened))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hint = F.col("text").rlike(r"[0-9a-zA-Z+/]{18,}|AKIA") & F.col("text").rlike(r"(?i)password|passwd|secret|token|api_?key|AKIA")
    some = common.cut(texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.max(hint).alias("hint")))  # sample * screened ids at most
    parts = [some.where(c).select("doc_id").orderBy(*order).limit(sample) for c in (F.col("hint"), ~F.col("hint"))]
    few = parts[0].unionByName(parts[1]).withColumn("label", F.lit(0))
    return train(common.labelled_texts(documents, few)[0])


def scan(documents: DataFrame, net: Network | None = None) -> DataFrame:
    """documents with n_assign, n_access, n_hex, n_model (long), base (the patterns' spans) and spans (all), both as
    kind:start:end joined by commas, in code points, and redacted (the text with every span marked out).

    Null texts count as empty: no spans; long ones are scanned whole. Spans of one kind never overlap; the network's
    overlap no other. Repeated rows each give a row, an empty table none; with no texts to learn from the network knows
    generated keys alone. Columns of these names are replaced; others pass through.
    """
    net = net or fitted(documents)

    def each(batch: pa.RecordBatch, net: Network) -> list[pa.Array]:
        rows = []
        for t in common.texts_of(batch):
            spans = all_spans(t, net)
            kinds = [k for k, _, _ in spans]
            rows.append((*(kinds.count(k) for k in KINDS), written([s for s in spans if s[0] != "model"]), written(spans), redact(t, spans)))
        return [pa.array(c) for c in zip(*rows, strict=True)]

    added = "n_assign long, n_access long, n_hex long, n_model long, base string, spans string, redacted string"
    return common.with_columns(documents.drop(*(c.split()[0] for c in added.split(", "))), added, each, net)


def digest(base: str) -> str:
    return hashlib.sha256(base.encode()).hexdigest()
