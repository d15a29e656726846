"""Every query with SQL gives the rows that DuckDB gives."""

import os
from collections import Counter

import pytest

from tesselia.plans import oracle, queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_oracle(spark, con, name):
    df = queries.QUERIES[name](spark, DATA)
    cur = con.execute(oracle.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = Counter(repr(tuple(r[names.index(n)] for n in order)) for r in cur.fetchall())
    assert Counter(repr(tuple(r[n] for n in order)) for r in df.collect()) == want


def test_all_queries_named():
    assert set(oracle.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracle.ORACLE_SQL)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
