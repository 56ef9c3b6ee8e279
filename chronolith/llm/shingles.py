"""Word and shingle hashes of many texts at once, in numpy, and MinHash signatures of them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from chronolith.llm.common import mix64

WORDS = 5
_RNG = np.random.default_rng(97)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_FACTOR = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True
_IS_START = np.ones(256, bool)
_IS_START[128:192] = False


@dataclass
class Words:
    """hashes: of the words of all texts, in order; bounds: where each text's words start, and the end; start, end: each
    word's place in its text, in code points."""

    hashes: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words_of(texts: list[str], places: bool = False) -> Words:
    """Words are runs of characters other than ASCII white space; lower and upper case are alike."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    blank = _IS_BLANK[b]
    inside = ~blank
    first = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
    last = np.flatnonzero(inside & np.concatenate([blank[1:], [True]])) + 1
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), _BASE, np.uint64)]))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[b] * power[:-1])])
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(b), _INVERSE, np.uint64)]))
    hashes = mix64((total[last] - total[first]) * back[first] + (last - first).astype(np.uint64))
    bounds = np.searchsorted(first, offsets)
    if not places:
        return Words(hashes, bounds, np.zeros(0, np.int64), np.zeros(0, np.int64))
    # Lower case may change a text's length (in few languages): those texts are measured as they are.
    points = np.concatenate([[0], np.cumsum(_IS_START[b])])
    base = points[offsets[:-1]]
    own = np.repeat(np.arange(len(texts)), np.diff(bounds))
    start, end = points[first] - base[own], points[last] - base[own]
    for k, t in enumerate(texts):
        if len(t.lower()) != len(t):
            ends = [i for i, c in enumerate(t) if c in " \t\n\v\f\r"]
            s, e, at = [], [], 0
            for i in [*ends, len(t)]:
                if i > at:
                    s.append(at)
                    e.append(i)
                at = i + 1
            start[bounds[k] : bounds[k + 1]], end[bounds[k] : bounds[k + 1]] = s, e
    return Words(hashes, bounds, start, end)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of so many words that lie in one text, and where each text's windows start, and the end."""
    w, n = words.hashes, len(words.hashes)
    many = np.diff(words.bounds)
    counts = np.maximum(many - size + 1, 0)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(len(many) + 1, np.int64)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += w[k : n - size + 1 + k] * _FACTOR[k]
    owner = np.repeat(np.arange(len(many)), many)
    ok = owner[: n - size + 1] == owner[size - 1 :]
    return mix64(total[ok]), np.concatenate([[0], np.cumsum(counts)])


def shingles(words: Words, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Windows of size words; a shorter text that has words is one shingle."""
    found, at = windows(words, size)
    many = np.diff(words.bounds)
    short = np.flatnonzero((many > 0) & (many < size))
    if len(short):
        one = np.array([int(mix64((words.hashes[words.bounds[k] : words.bounds[k + 1]] * _FACTOR[: many[k]]).sum(keepdims=True) + np.uint64(many[k]))[0]) for k in short], np.uint64)
        found = np.insert(found, at[short], one)
        more = np.zeros(len(many), np.int64)
        more[short] = 1
        at = at + np.concatenate([[0], np.cumsum(more)])
    return found, at


def minhash(found: np.ndarray, at: np.ndarray, count: int, seed: int = 41) -> np.ndarray:
    """For each text (found from at[k] to at[k + 1]) count minima, each scrambled to 8 bits; 0 where there is nothing."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**32, count, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 2**32, count, dtype=np.uint32)
    full = np.flatnonzero(np.diff(at) > 0)
    out = np.zeros((len(at) - 1, count), np.uint8)
    if not len(full):
        return out
    high = (found >> np.uint64(32)).astype(np.uint32)
    starts = at[:-1][full]
    for k in range(count):
        least = np.minimum.reduceat((high ^ b[k]) * a[k], starts)
        out[full, k] = (mix64(least.astype(np.uint64) + np.uint64(k << 33)) >> np.uint64(56)).astype(np.uint8)
    return out


def distinct(found: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    return [np.unique(found[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]


def joint_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets (each of distinct values)."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets) if n else np.zeros(0, np.uint64), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    place = np.cumsum(shared) - 1
    ok = shared[column]
    row, column = owner[ok], place[column[ok]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((n, n), np.float32)
    width = max(1, min(4096, 16_000_000 // max(n, 1)))
    for first in range(0, int(shared.sum()), width):
        s, e = np.searchsorted(column, [first, first + width])
        m = np.zeros((n, width), np.float32)
        m[row[s:e], column[s:e] - first] = 1
        out += m @ m.T
    out = np.rint(out).astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def similar(joint: np.ndarray, sizes: np.ndarray, tenths: int) -> np.ndarray:
    """Whether Jaccard similarity is at least tenths / 10, exactly."""
    return (10 * joint >= tenths * (sizes[:, None] + sizes[None, :] - joint)) & (joint > 0)
