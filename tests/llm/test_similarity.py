import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronolith.llm import cells, components, jaccard, passages, shingles, vectors

R = random.Random(8)
VOCABULARY = ["".join(R.choice("etaoinshrdlu") for _ in range(R.randint(2, 8))) for _ in range(800)]


def sentence(n, seed):
    r = random.Random(seed)
    return [r.choice(VOCABULARY) for _ in range(n)]


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def union_find(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_words_and_places():
    texts = ["", "one", " two  three\n", "Ünï çode\tx", "a\x0bb\x0cc", "İstanbul Big", "z" * 5000]
    words = shingles.words_of(texts, places=True)
    for k, t in enumerate(texts):
        s, e = words.bounds[k], words.bounds[k + 1]
        assert [t[a:b] for a, b in zip(words.start[s:e], words.end[s:e])] == t.split()
    again = shingles.words_of(["x ÜNÏ two", "one"])
    assert again.hashes[1] == words.hashes[words.bounds[3]] and again.hashes[2] == words.hashes[words.bounds[2]] and again.hashes[3] == words.hashes[words.bounds[1]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=40), max_size=6))
def test_shingles_of_any_texts(texts):
    if not texts:
        return
    found = shingles.distinct(*shingles.shingles(shingles.words_of(texts)))
    assert [len(f) for f in found] == [len(sets(t)) for t in texts]
    joint = shingles.joint_counts(found)
    assert all(joint[i, j] == len(sets(texts[i]) & sets(texts[j])) for i in range(len(texts)) for j in range(len(texts)))


def test_prefixes_shorten_until_the_recall():
    assert jaccard.depth(0.8, 0.9) > jaccard.depth(0.8, 0.999) >= 1
    d = jaccard.depth(0.8)
    assert 1 - (1 - 0.8**d) ** jaccard.TREES >= jaccard.RECALL > 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES
    assert passages.band_rows(0.8, 0.99) >= passages.band_rows(0.8, 0.9999)


def test_the_least_similarity_that_a_size_allows():
    for size in range(1, 40):
        every = [k / (size + m) for k in range(size + 1) for m in range(80) if 10 * k >= 8 * (size + m)]
        assert jaccard.least_similarity(size, 8) == min(every)
    need = jaccard.depths(8, jaccard.RECALL, jaccard.TREES)
    assert need[1] == need[2] == jaccard.LEVELS and need[-1] == jaccard.depth(0.8) and min(need) == need[-1]


def test_tries_link_what_shares_a_prefix():
    """Against all pairs: rows of a cell meet if the shorter of their prefixes is long enough for both; all that is linked is
    alike, and all that meets and is alike is linked, directly or not."""
    rng = np.random.default_rng(4)
    for n, small in ((30, 24), (60, 2), (200, 24)):
        jaccard.SMALL, before = small, jaccard.SMALL
        label = rng.integers(0, 2, (n, 8)).astype(np.uint8)
        cell, need, item = rng.integers(0, 3, n), rng.integers(2, 9, n).astype(np.int8), rng.permutation(n)
        alike = rng.random((n, n)) < 0.5
        alike |= alike.T
        i, j = jaccard.walked(cell, label, need, item, lambda a, b: alike[a, b] | (a == b))
        jaccard.SMALL = before
        assert all(alike[a, b] or a == b for a, b in zip(i, j, strict=True))
        meet = [(a, b) for a in range(n) for b in range(a) if cell[a] == cell[b] and alike[a, b] and (label[a, : max(need[a], need[b])] == label[b, : max(need[a], need[b])]).all()]
        got, want = union_find(n, [(int(a), int(b)) for a, b in zip(i, j, strict=True)]), union_find(n, meet)
        assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components_of_any_graph(spark, pairs):
    got = {r.id: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union_find(31, pairs)
    ids = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {i: want[i] for i in ids}


def test_components_of_a_long_chain_and_of_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.root for r in got if r.id <= 200} == {0} and {r.root for r in got if r.id >= 1000} == {1000} and len(got) == 501


def test_cells_meet_every_pair_once(spark):
    rows = [(k, i) for k, n in enumerate((1, 2, 7, 40)) for i in range(k * 100, k * 100 + n)]
    dealt = cells.dealt(spark.createDataFrame(rows, "bucket long, item long"), "bucket", "item", block=6).collect()
    met = []
    by = {}
    for r in dealt:
        by.setdefault(r.cell, []).append(r)
    for group in by.values():
        assert len(group) <= 40
        met += [frozenset((a.item, b.item)) for i, a in enumerate(group) for b in group[i + 1 :] if a.side < 0 or a.side != b.side]
    want = {frozenset((i, j)) for k, i in rows for k2, j in rows if k == k2 and i < j}
    assert len(met) == len(set(met)) and set(met) == want


def corpus():
    base = [" ".join(sentence(60, s)) for s in range(12)]
    rows = []
    for s, t in enumerate(base):
        rows.append(t)
        w = t.split()
        for k in range(s % 4):
            v = list(w)
            v[5 + 11 * k] = f"changed{s}x{k}"
            rows.append(" ".join(v))
    rows += [base[0].upper(), base[0].replace(" ", "\n "), base[1]] + [base[2]] * 30
    rows += ["short one", "short one", "Short  ONE", "another", "", " \n", None]
    return list(enumerate(rows))


def check_join(rows, got):
    ids = [i for i, _ in rows]
    s = [sets(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if s[a] and 10 * len(s[a] & s[b]) >= 8 * len(s[a] | s[b])]
    root = union_find(len(rows), links)
    counts = [0] * len(rows)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {ids[k]: (ids[root[k]], counts[k]) for k in range(len(rows))}


def test_join_against_all_pairs(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, item string")
    check_join(rows, jaccard.joined(df).collect())
    kept = {r.doc_id for r in jaccard.one_of_each(df).collect()}
    assert kept == {r.doc_id for r in jaccard.joined(df).collect() if r.doc_id == r.class_id}


def test_rows_that_repeat_beside_a_near_copy(spark):
    t = sentence(40, 61)
    near = " ".join([*t[:-1], "other"])
    t = " ".join(t)
    df = spark.createDataFrame([(1, t), (1, t), (2, near)], "doc_id long, text string")
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.joined(df).collect()) == [(1, 1, 2), (1, 1, 2), (2, 1, 2)]
    assert [(r.doc_id, r.text) for r in jaccard.one_of_each(df).collect()] == [(1, t)]
    df = spark.createDataFrame([(None, t), (2, near), (None, t), (7, None), (7, None), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.joined(df).collect()), key=str)
    assert got == sorted([(None, 2, 2), (None, 2, 2), (2, 2, 2), (7, 7, 0), (7, 7, 0), (None, None, 0)], key=str)
    assert sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(df).collect()), key=str) == sorted([(2, near), (7, None), (None, None)], key=str)


def test_different_texts_under_one_id_both_stay(spark):
    a, b = " ".join(sentence(40, 62)), " ".join(sentence(40, 63))
    df = spark.createDataFrame([(1, a, 1), (1, b, 2), (2, a, 3), (1, a, 4)], "doc_id long, text string, item int")
    assert sorted((r.doc_id, r.text) for r in jaccard.one_of_each(df).collect()) == sorted([(1, a), (1, b)])


def test_components_that_do_not_end_are_an_error(spark):
    with pytest.raises(RuntimeError):
        components.components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"), rounds=1)


def test_join_of_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 8)
    w = sentence(80, 77)
    rows = [(i, " ".join([*w[: 10 + i % 60], f"c{i}", *w[11 + i % 60 :]])) for i in range(40)] + [(100 + i, " ".join(sentence(30, 500 + i))) for i in range(5)]
    check_join(rows, jaccard.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_join_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.joined(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "g h"), (2, "word " * 40_000)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.joined(odd).collect()), key=str)
    assert got == sorted([(None, 1, 2), (1, 1, 2), (1, 1, 2), (1, 1, 0), (2, 2, 0)], key=str)


def vector_rows(seed=3, n=160, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    return [(i, [float(x) for x in np.float32(centres[i % 20] + rng.normal(size=dim) * rng.choice([0.02, 0.2, 0.3, 1.0]))], i % 3) for i in range(n)]


def check_links(rows, got, cosine=0.93):
    units = [None if v is None or lab is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v) else np.array(v, float) / np.linalg.norm(v) for _, v, lab in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if rows[a][2] == rows[b][2] and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine]
    root = union_find(len(rows), links)
    counts = [0] * len(rows)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {rows[k][0]: (counts[k], rows[root[k]][0], root[k] == k) for k in range(len(rows))}


def test_vectors_against_all_pairs(spark):
    rows = vector_rows()
    check_links(rows, vectors.linked(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, key int")).collect())


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(0, v, 1), (1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1), (10, [float("inf"), 1.0, 1.0], 1), (11, [*v, 0.0], 1), (12, [-1.0, -2.0, -3.0], 1)]
    check_links(rows, vectors.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert vectors.linked(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_a_dense_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cells, "BLOCK", 16)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in centre + rng.normal(size=16) * 0.05], 0) for i in range(120)] + [(200 + i, [float(x) for x in rng.normal(size=16)], 0) for i in range(30)]
    check_links(rows, vectors.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())


@pytest.mark.parametrize(("width", "count"), [(16, 3000), (64, 3000), (256, 1500), (768, 500), (1024, 500)])
def test_recall_of_the_hashing(width, count):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(count, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1)[:, None] * x
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * noise  # pairs exactly at the bound
    tables = vectors.tables_for(width)
    a, b = vectors.codes(x, tables), vectors.codes(y, tables)
    assert (vectors._first_meeting(a, b, tables, vectors.PROBES) >= 0).mean() > 0.995


@pytest.fixture(scope="module")
def shared_passages():
    passage = sentence(60, 900)
    near = sentence(70, 901)
    docs = [
        (1, " ".join(sentence(40, 1) + passage + sentence(30, 2))),
        (2, "\n".join([" ".join(sentence(50, 3)), " ".join(passage), " ".join(sentence(20, 4))])),
        (3, " ".join(sentence(200, 5))),
        (4, " ".join(sentence(10, 6)) + "\n" + " ".join(near)),
        (5, " ".join(sentence(15, 7)) + "\n" + " ".join(w if i != 35 else "other" for i, w in enumerate(near))),
        (6, " ".join(sentence(12, 8)) + "\n" + " ".join(sentence(55, 9)) + "\n" + " ".join(sentence(55, 9))),
        (7, None),
        (8, ""),
        (None, " ".join(passage)),
        (9, " ".join(w.upper() for w in passage)),
        (10, "x " * 60_000),
    ]
    return docs, passage, near


def test_passages_inside_paragraphs_and_near_paragraphs(spark, shared_passages):
    docs, passage, near = shared_passages
    df = spark.createDataFrame([(*d, "z") for d in docs], "doc_id long, text string, start string")
    rows = passages.repeats(df).collect()
    clusters = {}
    for r in rows:
        clusters.setdefault(r.cluster_id, set()).add(r.doc_id)
    assert sorted(map(sorted, clusters.values())) == [[1, 2, 9], [4, 5]]
    assert all(r.kept_doc_id in clusters[r.cluster_id] and r.removed == (r.doc_id > r.kept_doc_id) for r in rows)
    assert {r.doc_id for r in rows if r.removed} == {2, 9, 5}
    text = dict(docs)
    for r in rows:
        if r.doc_id == 2:
            assert text[2][r.start : r.end] in " ".join(passage)
    left = {r.doc_id: r.text for r in passages.without_repeats(df.drop("start")).collect()}
    assert " ".join(passage[15:45]) in left[1] and " ".join(passage[15:45]) not in left[2] and left[3] == text[3] and left[7] is None
    assert near[0] in left[4].split("\n")[1] and left[5].split("\n")[1] == ""


def test_two_passages_side_by_side_keep_a_copy_of_each(spark):
    x, y = sentence(70, 910), sentence(70, 911)
    rows = [(1, " ".join(x + sentence(30, 11))), (2, " ".join(sentence(20, 12) + x + y)), (3, " ".join(y + sentence(25, 13)))]
    left = " ".join(r.text for r in passages.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    for p in (x, y):
        assert left.count(" ".join(p[25:45])) == 1


def test_runs_are_covered_to_their_ends(spark):
    r = random.Random(8)
    rows, runs = [], []
    for trial, n in enumerate((50, 50, 55, 60, 70, 90)):
        run = sentence(n, 3000 + trial)
        runs.append(" ".join(run))
        for copy in range(2):
            around = [sentence(r.randint(20, 60), 4000 + 10 * trial + 2 * copy + k) for k in range(2)]
            rows.append((len(rows), " ".join(around[0] + ["a%d" % len(rows)] + run + ["b%d" % len(rows)] + around[1])))
    # Of the words before the third run a later pair has 15, which the first document lacks.
    longer = sentence(15, 3999) + runs[2].split()
    rows += [(100 + k, " ".join(sentence(30, 4100 + k) + [f"c{k}"] + longer + [f"d{k}"] + sentence(30, 4200 + k))) for k in range(2)]
    text = dict(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = passages.repeats(df).collect()
    for i, t in rows[:-2]:
        run = runs[i // 2]
        at = t.index(run)
        assert [(x.start, x.end) for x in got if x.doc_id == i] == [(at, at + len(run))]
    left = {x.doc_id: x.text for x in passages.without_repeats(df).collect()}
    assert " ".join(longer[:15]) in left[100] and longer[0] not in left[101].split() and " ".join(longer) in text[101]


def test_equal_paragraphs_shorter_than_a_passage_are_found(spark):
    same = {n: [" ".join(sentence(n, 7000 + 10 * n + k)) for k in range(5)] for n in (40, 42, 45, 49)}
    rows, wanted = [], {}
    for n, lines in same.items():
        for line in lines:
            for copy in range(2):
                i = len(rows)
                rows.append((i, "\n".join([" ".join(sentence(60, 8000 + i)), line, " ".join(sentence(60, 9000 + i))])))
                wanted[i] = (line, bool(copy))
    left = {r.doc_id: r.text for r in passages.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i, (line, gone) in wanted.items() if (line in left[i]) == gone] == []


def test_every_shared_run_holds_a_common_anchor():
    r = random.Random(5)
    for trial in range(30):
        run = sentence(passages.PASSAGE_WORDS, 2000 + trial)
        texts = [" ".join(sentence(r.randint(0, 60), 10 * trial + k) + run + sentence(r.randint(0, 60), 10 * trial + k + 5)) for k in range(2)]
        found, at = shingles.windows(shingles.words_of(texts), passages.ANCHOR_WORDS)
        chosen = passages.selected(found, at, passages.PASSAGE_WORDS - passages.ANCHOR_WORDS + 1)
        a, b = set(found[chosen[chosen < at[1]]]), set(found[chosen[chosen >= at[1]]])
        assert a & b


def test_passages_of_an_empty_table(spark):
    assert passages.repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_spans_belong_to_the_text_of_an_id(spark):
    passage, other = sentence(60, 950), " ".join(sentence(200, 951))
    rows = [(1, " ".join(sentence(30, 952) + passage)), (2, " ".join(passage + sentence(30, 953))), (2, other), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = passages.repeats(df).collect()
    assert {(r.doc_id, r.removed) for r in got} == {(1, False), (2, True)} and len(got) == 2
    left = sorted(passages.without_repeats(df).collect(), key=str)
    assert {(r.doc_id, r.text) for r in left} == {rows[0], (2, rows[1][1][len(" ".join(passage)) :]), (2, other), (2, None)}
