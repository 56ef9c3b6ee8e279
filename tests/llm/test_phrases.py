"""Collocations, alignment and the language model against plain Python."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronolith.llm import alignment, bpe, collocations, common, language, queries, toxicity

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations

def mined(rows, max_n, least, most, share):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for n in range(1, max_n + 1):
                for i in range(len(words) - n + 1):
                    counts[lang or "und"][tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and share * a <= 100 * b and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


ODD = [(None, "en"), ("", None), ("One\x0btwo one\ttwo  ONE two", "en"), ("É é É é.é É", None), ("a b\x1cc a b\x1cc,\x00 \x00", "en"), ("x" * 20_000 + " y " * 300, "en"), ("...;;!", "de"), ("ß ſ K ß ſ K", "de")]


@pytest.mark.parametrize(("max_n", "least", "most", "share"), [(5, 2, 2000, 100), (3, 3, 5, 60), (2, 1, 4, 100)])
def test_collocations(spark, monkeypatch, max_n, least, most, share):
    r = random.Random(max_n)
    rows = [(" ".join(r.choice(["a", "B", "the cat", "sat on", "c,", "d.", "E\n"]) for _ in range(r.randrange(40))), r.choice(["en", "de", None])) for _ in range(60)] + ODD + ODD
    df = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, phrase int, f int").repartition(3)
    for chars, bits in ((300, 26), (10**8, 17)):  # chunks and hashed bits don't matter
        monkeypatch.setattr(collocations, "CHUNK_CHARS", chars)
        monkeypatch.setattr(collocations.bitmap_of, "__defaults__", (bits,))
        got = collocations.mined(df, max_n, least, most, share)
        assert sorted(map(tuple, got.collect())) == mined(rows, max_n, least, most, share)
    assert collocations.mined(df.limit(0)).count() == 0 and collocations.mined(df.where("text = ''")).count() == 0


def test_phrases_that_have_no_frequent_part_are_not_counted(spark):
    df = spark.createDataFrame([("a b c. a b d. rare a b. e e e", "en")] * 3, "text string, lang string")
    words = collocations.counts(df, 1).where("f >= 6 AND phrase <> ''")
    pairs = {r.phrase: r.f for r in collocations.counts(df, 2, collocations.bitmap_of(words)).collect()}
    assert pairs == {"a b": 9, "e e": 6}


def test_scores_beyond_64_bits(spark):
    frequent = spark.createDataFrame([("en", 0, "", 10**16), ("en", 1, "a", 10**13), ("en", 1, "b", 3 * 10**12 + 7), ("en", 2, "a b", 10**12 + 1)], "lang string, size int, phrase string, f long")
    assert [r.score for r in collocations.scored(frequent).collect()] == [1000 * (10**12 + 1) * 10**16 // (10**13 * (3 * 10**12 + 7))]


# Alignment

def aligned(text):
    """A's and B's tokens of a text as (id, where it ends), or none."""
    a = alignment.first_tokenizer(None).encode(f" {text}", add_special_tokens=False).ids if text else []
    b = alignment.second_tokenizer(None).encode(text) if text else []
    out = []
    for ids, piece in ((a, bpe.pieces(None)), (b, alignment.second_pieces(None))):
        if b"".join(piece[i] for i in ids) != f" {text}".encode():
            return [], []
        out.append(list(zip(ids, np.cumsum([len(piece[i]) for i in ids]).tolist(), strict=True)))
    return out


def compared(texts):
    groups, links = [], []
    for a, b in map(aligned, texts):
        ends = sorted({e for _, e in a} & {e for _, e in b})
        bounds = list(zip([0, *ends], ends, strict=False))
        groups.append(";".join("|".join(",".join(str(i) for i, e in side if s < e <= t) for side in (a, b)) for s, t in bounds))
        links.append([(i, j) for e in ends for i, x in a if x == e for j, y in b if y == e])
    count = Counter(x for some in links for x in some)
    most = defaultdict(int)
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(len(a), len(b), g.count(";") + 1 if g else 0, len(some), sum(count[x] == most[x[1]] for x in some), sum(count[x] for x in some), hashlib.sha256(g.encode()).hexdigest() if g else "", g) for (a, b), g, some in zip(map(aligned, texts), groups, links, strict=True)]


TEXTS = ["", " ", "\n", "  two  spaces ", "line\nline\n\n line\r\n\tend", "<|endoftext|> <s> </s> <0x0A> <unk>", "x▁y", "▁", "naïve café ﬁ ① 漢字 \U0001f600‍", " nbsp em \x85 \x1c\x1f z", "á a\x00b", "don't we'll 12345 ...!!!", "nospaces" * 400, "word " * 3000, "\n" * 50, "it's  \n\n  it's"]


def test_units_are_encoded_as_in_their_text():
    assert alignment.separable(None)
    r = random.Random(4)
    pool = ["a", "Word", " ", "  ", "\n", "\r", "\t", ".", "'s", "7", " ", "é", "漢", "\x1c", " "]
    for text in [*TEXTS, *("".join(r.choice(pool) for _ in range(r.randrange(1, 40))) for _ in range(1500))]:
        found = alignment.units(text)
        if found:
            assert "".join(found) == f" {text}"
            assert [i for u in alignment.encode_first(found) for i in u] == alignment.first_tokenizer(None).encode(f" {text}", add_special_tokens=False).ids
            assert [i for u in alignment.encode_second(found) for i in u] == alignment.second_tokenizer(None).encode(text)
        else:
            assert not text or "▁" in text


def test_alignment(spark, monkeypatch):
    texts = [*TEXTS, None, TEXTS[4], TEXTS[4]]
    df = spark.createDataFrame([(i, t, 5, "k", i) for i, t in enumerate(texts)], "doc_id long, text string, u int, part string, n_links long").repartition(3)
    want = dict(enumerate(compared([t or "" for t in texts])))
    for chars in (30, 10**8):
        monkeypatch.setattr(bpe, "CHUNK_CHARS", chars)
        rows = alignment.compared(df, keep_groups=True).collect()
        assert {r.doc_id: tuple(r[-8:]) for r in rows} == want and len(rows) == len(texts) and {(r.u, r.part) for r in rows} == {(5, "k")}
    assert alignment.compared(df.limit(0)).count() == 0
    assert alignment.compared(df.select("text").where("text = '▁'")).columns == alignment.RESULT.replace(" long", "").replace(" string", "").split(", ")


@tables
def test_alignment_of_a_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    want = dict(zip(docs, compared([t or "" for t in docs.values()]), strict=True))
    assert {r.doc_id: tuple(r[1:]) for r in queries.op12_alignment(spark, DATA).collect()} == {i: w[:-1] for i, w in want.items()}


# Language model

def small(**sizes):
    words = pa.array(["", "a", "b", "c", "d", "e"])
    n = np.array([4, 40, 30, 20, 6, 5])
    return language.Words(words, n, language.spellings(words), 4, np.array([1, 2, 4]), 105, 9, *(np.full(language.SPELLINGS, x) for x in (12, 0.5, 4)))


def test_probabilities_sum_to_one():
    words = small()
    net = language.Net(words)
    net.flat[:] = np.random.default_rng(0).normal(0, 0.4, len(net.flat))
    symbols = np.arange(words.head + language.SPELLINGS).astype(np.uint16)
    h = np.repeat(np.random.default_rng(1).normal(size=(1, language.STATE)).astype(np.float32), len(symbols), 0)
    assert abs(np.exp(net.output(h, symbols)[0]).sum() - 1) < 1e-5
    share = 10 ** words.share(np.array([0, 3, 3, 3, 3]), np.zeros(5, np.int64))  # the unknown word, and four with 12 occurrences
    assert abs(share.sum() - 1) < 1e-9


def test_slopes_are_those_of_the_loss(monkeypatch):
    words = small()
    rng = np.random.default_rng(2)
    net = language.Net(words)
    net.flat[:] = rng.normal(0, 0.5, len(net.flat))
    ends = np.array([0, 9, 10, 30])
    symbols = rng.integers(0, words.head + language.SPELLINGS, 30).astype(np.uint16)
    monkeypatch.setattr(language, "WINDOW", 64)
    monkeypatch.setattr(language, "RATE", 0.0)
    slopes = np.zeros_like(net.flat)
    language.train(net, slopes, symbols, ends)
    loss = lambda: -language.log_probabilities(net, symbols, ends).sum() / 30
    for i in rng.choice(len(net.flat), 60, replace=False):
        kept = net.flat[i]
        net.flat[i] = kept + 0.01
        up = loss()
        net.flat[i] = kept - 0.01
        down = loss()
        net.flat[i] = kept
        assert abs(abs(up - down) / 0.02 - math.sqrt(slopes[i])) < 3e-3


def test_state_is_carried_through_a_text_and_not_beyond(monkeypatch):
    words = small()
    net = language.Net(words)
    net.flat[:] = np.random.default_rng(3).normal(0, 0.5, len(net.flat))
    rng = np.random.default_rng(4)
    sizes = [1, 700, 3, 40, 1, 5]
    texts = [rng.integers(0, words.head, n).astype(np.uint16) for n in sizes]
    ends = np.cumsum([0, *sizes])
    plain = []
    for t in texts:  # one step after the other
        h, before, total = np.zeros((1, language.STATE), np.float32), 0, 0.0
        for s in t.tolist():
            h = net.states(net.table(), np.array([[before]]), np.array([[False]]), h)[0]
            total += float(net.output(h, np.array([s], np.uint16))[0][0])
            before = s
        plain.append(total)
    for lanes, places in ((1, 0), (3, 64), (1024, 16_384)):
        monkeypatch.setattr(language, "SCORED_LANES", lanes)
        monkeypatch.setattr(language, "PLACES", places)
        assert np.allclose(language.log_probabilities(net, np.concatenate(texts), ends), plain, rtol=1e-4)
    assert language.stretches(np.array([0, 1, 1 + 2 * language.STRETCH + 5])).tolist() == [0, 1, 1 + language.STRETCH, 1 + 2 * language.STRETCH, 1 + 2 * language.STRETCH + 5]


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w] + [""]


def test_base_scores_and_odd_rows(spark, monkeypatch):
    r = random.Random(5)
    texts = [" ".join(r.choice(["the", "Cat", "sat", "on", "a", "mat."]) for _ in range(r.randrange(12))) for _ in range(150)]
    rows = [(i, t, i % 5 != 2, 1, "x") for i, t in enumerate([*texts, None, "", "É\x1cé one\x0btwo", "unseen words only", "w " * 5000, texts[0], texts[0]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, own boolean, at int, score string").repartition(3)
    for most, chars in ((4, 200), (language.DICTIONARY, language.CHUNK_CHARS)):
        monkeypatch.setattr(language.known_words, "__defaults__", (most, language.HEAD))
        monkeypatch.setattr(language, "CHUNK_CHARS", chars)
        got = {x.doc_id: x for x in language.scored(df, F.col("own")).collect()}
        count = Counter(w for _, t, own, *_ in rows if own for w in tokens(t))
        n, v = sum(count.values()), len(count)
        assert len(got) == len(rows)
        for i, t, *_ in rows:
            x = got[i]
            assert (x.at, x.n_tokens, x.n_known, x.train_tokens) == (1, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n)
            assert math.isclose(x.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t)), rel_tol=1e-9) and -1e6 < x.score < 0
        assert got[150].score == pytest.approx(got[151].score) and got[0].score == pytest.approx(got[155].score) == pytest.approx(got[156].score)
    none = language.scored(df, F.lit(None).cast("boolean")).collect()
    assert all(x.n_known == 0 and x.train_tokens == 0 and x.base_score == 0 and math.isfinite(x.score) for x in none)
    assert language.scored(df.limit(0), F.lit(True)).count() == 0


@tables
def test_language_model_of_a_table(spark):
    rows = queries.op13_language(spark, DATA).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.85 * sum(r.base_score for r in held) and sum(r.score > r.base_score for r in held) > 0.7 * len(held)
    again = {r.doc_id: r.score for r in queries.op13_language(spark, DATA).collect()}
    assert all(math.isclose(r.score, again[r.doc_id], rel_tol=1e-3) for r in rows)


def test_spellings_are_the_same_on_both_sides(spark):
    words = ["", "a", "ab.", "...", "é!", "漢字", "x')", "word", "wor\"d"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", language.spelling(F.col("w")).alias("k"))
    assert {r.w: r.k for r in df.collect()} == dict(zip(words, language.spellings(pa.array(words)).tolist(), strict=True))


# Counts of many words

def test_words_beyond_the_bits_of_their_number(monkeypatch):
    r = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in r.integers(0, 300, 60)) for _ in range(40)]
    want = toxicity.tally(texts, [i % 3 for i in range(40)])
    monkeypatch.setattr(toxicity, "NUMBER_BITS", 3)
    got = toxicity.tally(texts, [i % 3 for i in range(40)])
    for name in ("words", "texts", "followed", "pairs", "before", "n"):
        assert np.array_equal(getattr(got, name), getattr(want, name))


def test_ranges_are_merged_as_they_come(monkeypatch):
    r = np.random.default_rng(2)
    each = [toxicity.tally([" ".join(f"w{x}" for x in r.integers(0, 200, 50))], [i % 2]) for i in range(60)]
    rows = sorted(((part, t.packed()) for x in each for part, t in x.slices(3)), key=lambda x: x[0])
    batches = [pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows[k : k + 7]]), pa.array([b for _, b in rows[k : k + 7]], pa.binary())], names=["part", "packed"]) for k in range(0, len(rows), 7)]
    want = [t for t in toxicity._merged_ranges(batches)]
    held, real = [], toxicity.merged
    monkeypatch.setattr(toxicity, "HELD", 50)
    monkeypatch.setattr(toxicity, "merged", lambda parts: held.append(sum(len(p.before) for p in parts)) or real(parts))
    got = [t for t in toxicity._merged_ranges(batches)]
    assert len(got) == len(want) == 3 and all(np.array_equal(getattr(a, n), getattr(b, n)) for a, b in zip(got, want, strict=True) for n in ("words", "texts", "followed", "pairs", "before", "n"))
    assert max(held) < 4 * max(len(t.before) for t in want) < sum(len(x.before) for x in each)
    assert common.free(type("T", (), {"columns": ["_id", "_ID_"]}), "_id", "_id") == ["_id__", "_id___"]
