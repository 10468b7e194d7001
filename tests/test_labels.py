from __future__ import annotations

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rising, ticks
from tickloom.functions.columns import price_from_return
from tickloom.operators import backtest, labels
from tickloom.plans import training


def test_rising_prices(spark):
    prepared = labels.prepare_training(rising(spark)).orderBy("event_ts").collect()
    assert len(prepared) == 19
    assert prepared[0]["target_price"] == 101.0 and prepared[0]["target_return"] == pytest.approx(0.01)
    df = labels.prepare_training(rising(spark))
    assert labels.persistence_baseline(df).first()["rmse"] == pytest.approx(1.0)
    assert 0.0084 < labels.zero_return_baseline(df).first()["rmse"] < 0.01


def test_duplicates_do_not_make_labels(spark):
    rows = [("A", 100, 1, 0), ("A", 100, 1, 0), ("A", 110, 1, 1)]
    assert [r["target_price"] for r in labels.prepare_training(ticks(spark, rows)).collect()] == [110.0]


@pytest.mark.parametrize("times", [list(range(20)), [0] * 5 + [1] * 5 + [2] * 10, [3], [1, 1, 1], list(range(101))])
def test_split_equals_percent_rank(spark, times):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t int").withColumn("event_ts", F.timestamp_seconds("t"))
    rank = F.percent_rank().over(Window.orderBy("event_ts"))
    wanted = F.when(rank <= 0.7, "train").when(rank <= 0.7 + 0.15, "val").otherwise("test")
    both = labels.with_split(df).join(df.select("i", wanted.alias("want")), "i").collect()
    assert len(both) == len(times) and all(r["split"] == r["want"] for r in both)
    parts = labels.chronological_split(df)
    assert sum(p.count() for p in parts) == len(times)


@pytest.mark.parametrize("compat", [True, False])
def test_walk_forward_chunks(spark, compat):
    df = spark.range(23).withColumn("event_ts", F.timestamp_seconds("id"))
    rank = F.percent_rank().over(Window.orderBy("event_ts"))
    want = {
        r["id"]: next((i for i in range(5) if i / 5 <= r["rank"] < (i + 1) / 5), None if compat else 4)
        for r in df.withColumn("rank", rank).collect()
    }
    got = {r["id"]: r["chunk"] for r in labels.walk_forward_chunks(df, 5, compat).collect()}
    assert got == {k: v for k, v in want.items() if v is not None}


def test_metrics_match_mllib(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.range(50).select((F.col("id") * 1.5).alias("y"), (F.col("id") * 1.4 + F.sin("id")).alias("p"))
    mine = labels.regression_metrics(df, "y", "p").first()
    for name in ("rmse", "mse", "mae", "r2", "var"):
        theirs = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert mine[name] == pytest.approx(theirs, rel=1e-9), name


def test_gate(spark):
    rows = [(0.95, 2.0, 1.0), (1.05, 2.0, 1.0), (0.99, 2.0, None), (1.0, 2.0, 1.0), (0.95, 0.9, 1.0)]
    df = spark.createDataFrame(rows, "test_rmse double, zero_return_rmse double, production_rmse double")
    assert [r["promotable"] for r in labels.promotion_gate(df).collect()] == [True, False, True, True, False]
    strict = labels.promotion_gate(spark.createDataFrame([(0.99, 2.0, 1.0)], df.schema), min_improvement_pct=2.0)
    assert strict.first()["promotable"] is False


def test_price_from_return(spark):
    row = spark.range(1).select(price_from_return(F.lit(100.0), F.lit(-0.005)).alias("p")).first()
    assert row["p"] == pytest.approx(99.5)


def plain_backtest(pairs, capital=10_000.0):
    made = [(1 if p > 0 else -1) * r for p, r in pairs]
    equity, peak, worst = capital, -math.inf, 0.0
    for r in made:
        equity *= 1 + r
        peak = max(peak, equity)
        worst = min(worst, (equity - peak) / peak)
    mean = sum(made) / len(made)
    std = math.sqrt(sum((m - mean) ** 2 for m in made) / (len(made) - 1)) if len(made) > 1 else 0.0
    losses = sum(m for m in made if m < 0)
    return {
        "n_trades": len(made),
        "total_return": equity / capital - 1,
        "sharpe_ratio": mean / std * math.sqrt(252) if std > 0 else 0.0,
        "max_drawdown": worst,
        "win_rate": sum(m > 0 for m in made) / len(made),
        "profit_factor": sum(m for m in made if m > 0) / abs(losses) if losses else math.inf,
        "directional_accuracy": sum((p > 0) == (r > 0) for p, r in pairs) / len(pairs),
        "buy_and_hold_return": math.prod(1 + r for _, r in pairs) - 1,
    }


@pytest.mark.parametrize("slice_rows", [None, 7])
@pytest.mark.parametrize("pairs", [[(0.1, 0.02), (-0.1, 0.03), (0.0, -0.01), (0.2, -0.04)] * 12, [(0.1, 0.02)], [(0.1, 0.01), (0.1, 0.01)]])
def test_backtest_equals_plain_loop(spark, sliced, slice_rows, pairs):
    if slice_rows:
        sliced(slice_rows)
    rows = [("A", i, float(p), float(r)) for i, (p, r) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "symbol string, event_ts int, predicted_return double, realized_return double")
    for keys in (("symbol",), ()):
        got = backtest.backtest_summary(df.repartition(3), keys).first().asDict()
        for name, value in plain_backtest(pairs).items():
            assert got[name] == pytest.approx(value, abs=1e-9), name


def test_backtest_of_nothing_is_zero(spark):
    df = spark.createDataFrame([], "symbol string, event_ts int, predicted_return double, realized_return double")
    row = backtest.backtest_summary(df, ()).first()
    assert row["n_trades"] == 0 and all(row[c] == 0.0 for c in backtest.SUMMARY)


def test_training_gate_on_a_trend(spark):
    report = training.train_and_evaluate(rising(spark, 60), maxIter=3, maxDepth=2)
    assert report["persistence_rmse"] == pytest.approx(1.0)
    assert report["promotable"] == (report["beats_baseline"] and report["beats_production"])
    assert report["beats_production"] is True and report["backtest"]["n_trades"] > 0
    assert report["beats_baseline"] == (report["test_rmse"] < report["zero_return_rmse"])


def test_walk_forward(spark):
    results = training.walk_forward_validate(labels.prepare_training(rising(spark, 80)), 2, maxIter=2, maxDepth=2)
    assert [r["window"] for r in results] == [0, 1]
    assert all(r["beats_zero_return"] == (r["val_rmse"] < r["zero_return_rmse"]) for r in results)


def test_variance_at_high_prices(spark):
    rows = [(118_420.0 + i % 2 * 0.05, 118_420.0 + i % 3 * 0.07) for i in range(60)]
    got = labels.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()["var"]
    mean = sum(y for y, _ in rows) / len(rows)
    assert got == pytest.approx(sum((p - mean) ** 2 for _, p in rows) / len(rows), rel=1e-6)


def test_walk_forward_in_parallel_gives_the_same(spark):
    prepared = labels.prepare_training(rising(spark, 120))
    one, many = (training.walk_forward_validate(prepared, 3, maxIter=2, maxDepth=2, parallel=k) for k in (1, 3))
    assert one == many and [r["window"] for r in many] == [0, 1, 2]
