import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronolith.llm import secrets

KEY = "b7db7aa4a5fcc78305aa"


def plainly(text):
    """The base patterns as they are written, without any shortcut."""
    found = []
    for m in re.finditer(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], secrets.ORDER[s[0]]))


@pytest.mark.parametrize(
    "text",
    [f"password={KEY}", f'Token = "{"0a" * 20}" end', "secret: token: abcdefghij", "password=token=abcdefgh12", "AKIA" + "Q" * 12, "AKIA" + "Q" * 11, "0" * 31, "x" + "f" * 32 + "g" + "0" * 40, "paſſword=abcdefghij", "toKen=abcdefghij", "ünï api_key='abcdefgh' APIKEY:zzzzzzzz", "", "passwd=short", "a" * 100 + "AKIA" * 9],
)
def test_base_spans(text):
    assert secrets.base_spans(text) == plainly(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "secret", "api_key", "APIkey", "token", "=", ": ", '"', "'", " ", "AKIA", "QW12", "0123456789abcdef", "f", "g", "é", "K", "\n", "-", "/"]), max_size=25))
def test_base_spans_of_any_text(parts):
    text = "".join(parts)
    assert secrets.base_spans(text) == plainly(text)


@pytest.fixture(scope="module")
def network():
    r = random.Random(1)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(80)) + f" password={''.join(r.choice('0123456789abcdef') for _ in range(18))} " + " ".join(r.choice(words) for _ in range(20)) for _ in range(120)]
    return secrets.train(texts)


def test_the_network_finds_other_keys_and_leaves_words(network):
    r = random.Random(9)
    draw = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    keys = [f"use sk-{draw(40)} here" for _ in range(50)]
    assert sum(any(k == "model" for k, _, _ in secrets.all_spans(t, network)) for t in keys) >= 45
    plain = ["see 2024-01-15-meeting-notes and call 555-123-4567.home.example today", "the internationalization2 of misunderstandings", "www.example.com/articles/2024/summer-holiday"]
    assert sum(len(secrets.all_spans(t, network)) for t in plain) <= 1
    assert network.recall >= 0.95


def test_a_key_anywhere_in_a_long_run_is_found(network):
    r = random.Random(12)
    draw = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    found = 0
    for _ in range(50):
        run = f"api.host.example/v1/accounts/{draw(40)}/resources/list/items/index"
        found += ("model", 4, 4 + len(run)) in secrets.all_spans(f"see {run} there", network)
    assert found >= 45
    covered = {i for w in secrets.windows("".join(map(chr, range(33, 127))) + " ", 0, 94) for i in w[secrets.LEFT : secrets.LEFT + secrets.BODY]}
    assert covered >= set(range(33, 127))


def test_base_spans_stay_and_the_networks_overlap_none(network):
    text = f'token = "{"0a1b" * 10}" and sk-{"aB3dE6gH" * 5} end'
    spans = secrets.all_spans(text, network)
    assert [s for s in spans if s[0] != "model"] == plainly(text)
    for _, s, e in [x for x in spans if x[0] == "model"]:
        assert all(e <= s2 or s >= e2 for k, s2, e2 in spans if k != "model")


def test_scan_of_a_table(spark, network):
    rows = [(1, f"password={KEY}"), (2, None), (3, ""), (4, "é" * 5 + "AKIA" + "Q" * 20), (4, "é" * 5 + "AKIA" + "Q" * 20), (None, "0" * 40), (5, "word " * 50_000 + "f" * 32)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    got = {(r.doc_id, r.text): r for r in secrets.scan(df, network).collect()}
    for doc, text in set(rows):
        r, base = got[doc, text], plainly(text or "")
        assert r.base == secrets.written(base) and (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
    assert got[1, f"password={KEY}"].redacted == "[SECRET]"
    assert secrets.digest("") == hashlib.sha256(b"").hexdigest()
    assert secrets.scan(df.limit(0), network).count() == 0
    assert 0 < secrets.fitted(df.limit(0)).threshold <= 1


def test_every_long_run_is_a_candidate_but_for_what_is_taken():
    text = "abcdefghijklmnopqrst x " + "a" * 20 + "=" + "0" * 40 + "/" + "b" * 20 + " short"
    taken = [("hex", 44, 84)]
    assert secrets.candidates(text, []) == [(0, 20), (23, 105)]
    assert secrets.candidates(text, taken) == [(0, 20), (23, 44), (84, 105)]
    assert secrets.candidates(text, [("assign", 23, 100), ("hex", 44, 84)]) == [(0, 20)]
    assert secrets.candidates("", []) == []


def test_the_network_adds_spans_to_a_table(spark):
    """Keys that no pattern knows, in texts like those of the table."""
    r = random.Random(4)
    draw = lambda n: "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    texts = [(x.doc_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if x.text and len(x.text) > 100]
    planted = [(10_000 + i, f"{t[:50]} sk-{draw(40)} {t[50:]}") for i, t in texts]
    schema = "doc_id long, text string"
    rows = secrets.scan(spark.createDataFrame(texts + planted, schema), secrets.fitted(spark.createDataFrame(texts, schema))).collect()
    assert sum(x.n_model > 0 for x in rows if x.doc_id >= 10_000) >= 0.9 * len(planted)
    assert sum(x.n_model for x in rows if x.doc_id < 10_000) <= 0.05 * len(texts)


def test_the_threshold_keeps_the_recall():
    r = random.Random(3)
    net = secrets.train([" ".join("".join(r.choice("etaoinshr") for _ in range(6)) for _ in range(80)) for _ in range(40)], recall=0.98)
    assert net.recall >= 0.98
