"""The registered queries on the driver's smallest tables, against brute force."""

import hashlib
import os
import re
import zlib

import pytest
import test_secrets
import test_similarity
import test_texts

import corpus_pipeline as cp
from chronolith.llm import bpe, mixing, queries, registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_names():
    assert len(registry.queries()) == 13
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "bpe"]


@pytest.mark.parametrize(("query", "mod", "rest"), [(queries.op1_toxicity, 4, 2), (queries.op2_quality, 5, 0)])
def test_scores(spark, docs, query, mod, rest):
    got = {r.doc_id: r for r in query(spark, DATA).collect()}
    assert set(got) == set(docs)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % mod == rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_fingerprints(spark, docs):
    want = test_texts.edited({i: r.text for i, r in docs.items()})
    got = {r.doc_id: r for r in queries.op3_fingerprints(spark, DATA).collect()}
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {i: (len(docs[i].text or ""), sha(want[i])) for i in docs}
    by_text = {}
    for i, r in got.items():
        by_text.setdefault(docs[i].text or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)


def test_mixing(spark, docs):
    got = {r.doc_id: r for r in queries.op4_mixing(spark, DATA).collect()}
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in docs.items()}
    assert {i: r.size for i, r in got.items()} == sizes and all(r.taken <= 3 * r.size for r in got.values())
    names = sorted({r.source for r in docs.values()}, key=lambda s: (s is None, s or ""))
    of = {s: [i for i in docs if docs[i].source == s] for s in names}
    totals = [sum(sizes[i] for i in of[s]) for s in names]
    for s, total, target in zip(names, totals, mixing.targets(totals)):
        assert all(got[i].source_size == total and abs(got[i].target - target) < 1e-6 for i in of[s])
        assert abs(sum(got[i].taken for i in of[s]) - target) <= mixing.BLOCK_WORDS


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    for r in queries.op5_bpe(spark, DATA).collect():
        ids = t.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))


def test_secrets_query(spark, docs):
    for r in queries.op6_secrets(spark, DATA).collect():
        base = test_secrets.plainly(docs[r.doc_id].text or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in base))
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(r.spans.split(","))


def test_jaccard(spark, docs):
    test_similarity.check_join([(i, r.text) for i, r in sorted(docs.items())], queries.op7_jaccard(spark, DATA).collect())


def test_vectors(spark):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()]
    test_similarity.check_links(rows, queries.op9_vectors(spark, DATA).collect())


def test_passages(spark, docs):
    got = queries.op10_passages(spark, DATA).collect()
    words = {i: [(m[0].lower(), *m.span()) for m in re.finditer(r"\S+", r.text or "")] for i, r in docs.items()}
    seen = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            seen.setdefault(tuple(x[0] for x in w[k : k + 50]), []).append((i, k))
    spans = {}
    for r in got:
        spans.setdefault(r.doc_id, []).append((r.start, r.end, r.removed))
    shared = [v for v in seen.values() if len({i for i, _ in v}) > 1]
    assert shared
    for where in shared:
        first = min(i for i, _ in where)
        for i, k in where:
            start, end = words[i][k][1], words[i][k + 49][2]
            assert any(s < end and e > start for s, e, _ in spans[i])
            assert i == first or any(s < end and e > start and gone for s, e, gone in spans[i])


ODD = "doc_id long, text string, lang string, source string, n_chars long, score string, predicted string, item string, redacted string, size string, hash string, ids string, class_id string, pieces string"


def odd_tables(spark, folder, rows):
    spark.createDataFrame(rows, ODD).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, i % 2) for i in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_of_odd_rows(spark, tmp_path):
    x = ("x",) * 9
    rows = [(i, " ".join(f"w{(i * 7 + k) % 53}" for k in range(40)) + (" badword grim" if i % 2 else ""), "en", f"s{i % 3}", 5, *x) for i in range(20)]
    rows += [(20, None, None, None, None, *x), (21, "", "en", "s0", 0, *x), (22, "long " * 50_000, None, None, 1, *x), (23, "same words here", "en", "s1", 1, *x), (23, "same words here", "en", "s1", 1, *x), (None, "no id at all", "en", "s1", 1, *x), (24, "password=0123456789abcdef0123", "en", "s9", 1, *x)]
    odd_tables(spark, tmp_path, rows)
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES:
        kept = stage(spark, kept, str(tmp_path)).persist()
        assert kept.count() > 0
        if name == "secrets":
            assert not any("0123456789abcdef" in (r.text or "") for r in kept.collect())
        if name == "near_duplicates":
            ids = [r.doc_id for r in kept.collect()]
            assert ids.count(23) == 1


def test_pipeline_of_empty_tables(spark, tmp_path):
    odd_tables(spark, tmp_path, [])
    assert cp.run(spark, str(tmp_path)).count() == 0
