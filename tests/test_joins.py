"""Rows of slides are joined without broadcasts, however small estimates from file sizes say they are."""

import os

import pytest

from tesselia.plans import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def no_broadcast(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    df.collect()  # the adaptive plan is final after it
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_read_addresses(spark):
    no_broadcast(spark, "q_read_addresses")


def test_tissue_fraction(spark):
    no_broadcast(spark, "q_tissue_fraction")


def test_gated_plan(spark):
    no_broadcast(spark, "q_gated_plan")
