"""The registered queries over the driver's smallest tables, and the pipeline."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from tesselia.llm import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cur = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    df = registry.QUERIES[name](spark, DATA)
    order = sorted(names)
    assert sorted(df.columns) == order
    want = Counter(repr(tuple(r[names.index(n)] for n in order)) for r in cur.fetchall())
    assert Counter(repr(tuple(r[n] for n in order)) for r in df.collect()) == want


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.through_table(stage(spark, docs, DATA), "test-stage")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and 0 < out.count() <= docs.count()
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.count() == docs.count()
