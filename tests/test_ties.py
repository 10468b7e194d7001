"""Tables in which several ticks of a symbol share one time: the order of ids settles them, as in the SQL forms."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, predictions as table
from oracle import difference
from tickloom.operators import predictions as p
from tickloom.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
ON_REALIZED = [
    "accuracy_by_symbol", "accuracy_overall", "concept_drift", "concept_drift_newest_first", "drift_report", "error_in_tolerance",
    "oldest_unrealized", "predictions_after_update", "realize_fifo", "recent_return_errors", "unrealized_backlog",
]


@pytest.fixture(scope="module")
def tied(spark, tmp_path_factory, sf_small):
    """Every event three times at one time, under three ids."""
    import duckdb

    folder = tmp_path_factory.mktemp("tied")
    con = duckdb.connect()
    copies = f"SELECT e.* REPLACE (event_id + 1000000 * k AS event_id) FROM '{sf_small}/events.parquet' e, range(3) AS r(k)"
    con.execute(f"COPY ({copies}) TO '{folder}/events.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet'")
    return con, str(folder)


@pytest.mark.parametrize("name", ON_REALIZED)
def test_tied_query_equals_sql(spark, tied, name):
    con, folder = tied
    assert difference(QUERIES[name](spark, folder), con, SQL[name]) is None


@pytest.mark.parametrize("slices", [None, 5])
def test_the_next_price_of_the_same_time_realizes(spark, sliced, slices):
    if slices:
        sliced(slices)
    stored = table(spark, [(i, "A", i // 4, 100, 0, 0.0) for i in range(2, 12)])
    seen = spark.createDataFrame([("A", START + timedelta(seconds=i // 4), 1000.0 + i, i) for i in range(12)], "symbol string, event_ts timestamp, price double, n int")
    got = {r["id"]: r["realized_error"] for r in p.realize_fifo(stored, seen, ["n"], "n").collect()}
    assert got == {**{i: 1001.0 + i for i in range(2, 11)}, 11: None}
    late = p.realize_fifo(stored, seen.where(F.col("n") < 8), ["n"], "n").where("realized_error is not null")
    assert sorted(r["id"] for r in late.collect()) == [2, 3, 4, 5, 6]
