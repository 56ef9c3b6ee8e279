"""Every query against its SQL, on the smallest tables."""

import math
import os

import pytest

from chronolith.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(row):
    return tuple(round(v, 6) if isinstance(v, float) and math.isfinite(v) else v for v in row)


def ordered(rows):
    return sorted(map(plain, rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    result = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert ordered(tuple(r[c] for c in columns) for r in df.collect()) == ordered(want)


def test_queries_without_sql(spark):
    for name in set(catalogue.queries()) - set(catalogue.oracle_sql()):
        assert catalogue.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
