"""The two classifiers on rows of the driver's tables that they have not seen, and op2's evidence recomputed plainly."""

import math
import os

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from chronolith.llm import common, quality, queries

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


def judged(spark, query, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if r[label] is not None}
    rows = [r for r in query(spark, DATA).collect() if r.held_out and r.doc_id in labels]
    return {k: [r.predicted for r in rows if labels[r.doc_id] == k] for k in (0, 1)}


def test_held_out_toxic_documents_are_caught(spark):
    found = judged(spark, queries.op1_toxicity, "toxic")
    assert len(found[1]) >= 5 and sum(found[1]) >= 0.5 * len(found[1]) and sum(found[0]) <= 0.1 * len(found[0])


def test_held_out_bad_documents_are_rejected(spark):
    found = judged(spark, queries.op2_quality, "quality")
    assert len(found[0]) >= 5 and sum(found[0]) <= 0.5 * len(found[0]) and sum(found[1]) >= 0.95 * len(found[1])


def plainly(model, text):
    """The score of one text, by plain calls."""
    raw = text.encode()
    if not raw:
        return None
    cuts = list(range(0, len(raw), 4096)) + [len(raw)]
    if len(cuts) > 2 and cuts[-1] - cuts[-2] < 1024:
        del cuts[-2]
    sizes = []
    for words in (None, model.good, model.bad):
        known = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
        maker = zstandard.ZstdCompressor(level=1, write_content_size=False, write_checksum=False, write_dict_id=False, **known)
        sizes.append(sum(len(maker.compress(raw[s:e])) for s, e in zip(cuts, cuts[1:], strict=False)) / len(raw))
    plain, good, bad = sizes
    a, b, c, d, e = 10 * (good - bad), 10 * (good - bad) / plain, 5 * good, 5 * plain, 0.3 * math.log(1 + len(raw))
    x = [a, b, c, d, e, a * a, b * b, c * c, d * d, e * e, a * c, a * d, a * e, c * d]
    return 1 / (1 + math.exp(-np.clip(np.dot(model.weights[:-1], x) + model.weights[-1], -30, 30)))


def test_the_scores_of_op2_are_those_of_plain_calls(spark):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where(common.bucket_of(F.col("doc_id"), 5) != 0)
    model = quality.fitted(documents, labels)
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    got = {r.doc_id: r.score for r in queries.op2_quality(spark, DATA).collect()}
    assert set(got) == set(texts)
    for i, t in list(texts.items())[:400]:
        if t:
            assert math.isclose(got[i], plainly(model, t), rel_tol=1e-6, abs_tol=1e-9)
