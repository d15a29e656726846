"""Learned operators on the driver's tables: held-out rows, labels that must not matter, empty and repeated rows."""

import os
import zlib

import pytest
from pyspark.sql import functions as F

from tesselia.llm import quality, registry, toxicity

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")

def fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4



def tables(spark):
    return (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))


def test_toxicity_held_out(spark):
    """Accuracy beyond the base rate on rows never learned from, and equal scores whatever their labels say."""
    docs, labels = tables(spark)
    turned = labels.withColumn("toxic", F.when(fold() == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.score_toxicity(docs, toxicity.train(docs, x, where=fold() != 2)) for x in (labels, turned))
    scores = {r.doc_id: (r.score, r.predicted) for r in one.collect()}
    assert scores == {r.doc_id: (r.score, r.predicted) for r in two.collect()}
    rows = registry.op9_toxicity(spark, DATA).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and (r.score, r.predicted) == scores[r.doc_id] for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.filter(fold() == 2).filter("toxic is not null").collect()}
    right = sum(scores[i][1] == t for i, t in truth.items()) / len(truth)
    assert right > max(sum(truth.values()), len(truth) - sum(truth.values())) / len(truth) + 0.02


def test_quality_held_out(spark):
    docs, labels = tables(spark)
    model = quality.train(docs, labels.filter(fold() != 2))
    kept = {r.doc_id: r.kept for r in quality.score_quality(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.filter(fold() == 2).filter("quality is not null").collect()}
    right = sum(kept[i] == bool(t) for i, t in truth.items()) / len(truth)
    assert right > max(sum(truth.values()), len(truth) - sum(truth.values())) / len(truth) + 0.02


def test_empty_and_repeated(spark):
    docs, labels = tables(spark)
    tox, good = toxicity.train(docs, labels), quality.train(docs, labels)
    for score, model in ((toxicity.score_toxicity, tox), (quality.score_quality, good)):
        assert score(docs.limit(0), model).count() == 0
        twice = docs.limit(5).union(docs.limit(5))
        assert score(twice, model).count() == 10 and score(twice, model).distinct().count() == 5
    assert quality.score_quality(docs.withColumn("text", F.repeat("text", 200)).limit(3), good).count() == 3
