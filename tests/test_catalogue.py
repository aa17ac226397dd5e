"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from caselake.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def normal(rows):
    show = lambda v: "null" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    cols = sorted(got.columns)
    want = duck.sql(catalogue.SQL[name])
    assert sorted(want.columns) == cols
    order = [want.columns.index(c) for c in cols]
    assert normal(got.select(*cols).collect()) == normal([[r[i] for i in order] for r in want.fetchall()])


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
