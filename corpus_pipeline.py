"""The corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
``documents``. Stages are written as Parquet in the shared folder and read again, which cuts lineage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tesselia.llm import bpe, decontam, exact_dedup, near_dedup, quality
from tesselia.llm.common import DOC_COLUMNS, pick
from tesselia.session import through_table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier accepts; it learns from those of ``docs`` that are labelled."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model, keep_columns=True)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact_dedup.drop_copies(pick(docs, *DOC_COLUMNS) if docs.columns != list(DOC_COLUMNS) else docs)


def keep_one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles with a similarity of 0.8 or more, the one with the smallest id."""
    return near_dedup.drop_near_copies(docs, words=5, percent=80)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and a digest of the decoded text."""
    return bpe.encode_ids(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_one_copy),
    ("MinHash near-dedup", keep_one_of_alike),
    ("benchmark decontamination", keep_clean),
    ("BPE encoding and decoding", encode),
]

#: A trained classifier and BPE merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = through_table(stage(spark, docs, sf_dir), f"pipeline-{n}")
    return docs
