"""Calls that stop at a failure and go on where they stopped."""

import os
import time
from collections import Counter

import pytest

from chronolith.operators import generate


@pytest.fixture
def asked(spark):
    return spark.createDataFrame([(i, f"p{i:03}") for i in range(40)], "id long, prompt string")


def made(folder):
    """How often each prompt was called."""
    return Counter(n.split(".")[0] for n in os.listdir(folder))


def noting(folder):
    def noted(prompt):
        with open(f"{folder}/{prompt}.{time.time_ns()}", "w"):
            pass

    return noted


def test_a_failure_stops_the_calls_and_the_next_try_goes_on(spark, asked, tmp_path):
    calls, path = tmp_path / "calls", f"{tmp_path}/results"
    calls.mkdir()
    noted = noting(str(calls))

    def fails(prompt):
        noted(prompt)
        time.sleep(0.05)
        if prompt == "p007":
            raise ValueError("no")
        return prompt.upper()

    with pytest.raises(RuntimeError, match="ValueError: no"):
        generate.resumed(asked, fails, path, "id", chunk=4, jobs=2)
    first = made(calls)
    assert first["p007"] == 1 and 1 <= sum(first.values()) < 40
    kept = {r.prompt for r in generate.results(spark, path, generate.run(asked, str).schema).where("status = 'ok'").collect()}

    def works(prompt):
        noted(prompt)
        return prompt.upper()

    out = generate.resumed(asked, works, path, "id", chunk=4, jobs=2)
    assert sorted(r.output for r in out.collect()) == [f"P{i:03}" for i in range(40)]
    second = made(calls)
    assert all(second[p] == 1 for p in kept) and second["p007"] == 2 and sum(second.values()) <= 40 + 2 * 4
    assert generate.resumed(asked, works, path, "id").count() == 40 and made(calls) == second  # nothing is left to do


def test_failures_that_are_tolerated_are_tried_again(spark, asked, tmp_path):
    path = f"{tmp_path}/results"
    odd = generate.resumed(asked, lambda p: 1 / 0 if int(p[1:]) % 2 else p, path, "id", chunk=7, keep_going=True)
    assert odd.count() == 20
    rows = generate.results(spark, path, generate.run(asked, str).schema)
    assert generate.ledger(rows, "id").where("status = 'failed'").count() == 20
    assert generate.resumed(asked, str, path, "id", chunk=7).count() == 40
    for bad in ({"chunk": 0}, {"jobs": 0}):
        with pytest.raises(ValueError):
            generate.resumed(asked, str, path, "id", **bad)
    assert generate.resumed(asked.limit(0), str, f"{tmp_path}/none", "id").count() == 0


def test_a_worker_that_dies_costs_the_calls_of_its_chunk(spark, asked, tmp_path):
    calls, path, once = tmp_path / "calls", f"{tmp_path}/results", f"{tmp_path}/died"
    calls.mkdir()
    noted = noting(str(calls))

    def dies(prompt):
        noted(prompt)
        if prompt == "p011" and not os.path.exists(once):
            open(once, "w").close()
            os._exit(1)
        return prompt

    for _ in range(2):  # in local mode a task isn't tried again, so the first try may end in an error
        try:
            out = generate.resumed(asked, dies, path, "id", chunk=4, jobs=1)
        except Exception:
            continue
    assert out.count() == 40
    again = {p: n for p, n in made(calls).items() if n > 1}
    assert "p011" in again and len(again) <= 10
