"""Every registered query against its SQL form on the given tables, plain and with sliced keys."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from oracle import connect, difference

from tickloom.plans import catalog

# The text operators have tests of their own.
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
ROWS_ONLY = {"gbt_predictions"}
pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck(sf_small):
    return connect(sf_small)


def test_only_random_or_fitted_queries_have_no_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf_small, name):
    assert difference(QUERIES[name](spark, sf_small), duck, SQL[name]) is None


SLICED = [
    "tick_features", "trade_tick_features", "prepare_training", "equity_curve", "backtest_one_account",
    "realize_fifo_backlog", "realize_asof", "concept_drift", "feature_drift", "walk_forward_baselines",
]


@pytest.mark.parametrize("name", SLICED)
def test_sliced_query_equals_sql(spark, duck, sf_small, sliced, name):
    sliced(13)
    assert difference(QUERIES[name](spark, sf_small), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert "ma20" in df.columns and df.count() > 0
