"""Model training as Spark jobs: fit, evaluate on held-out time, gate, back-test, walk forward."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import labels
from tickloom.operators.backtest import backtest_summary
from tickloom.operators.features import tick_order
from tickloom.operators.labels import TARGET
from tickloom.schemas import MODEL_FEATURES
from tickloom.sources.scratch import settled


def gbt_pipeline(features: Sequence[str] = MODEL_FEATURES, label: str = TARGET, **params) -> Pipeline:
    """Boosted trees on the given features; rows with missing features are skipped."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    # Number and depth of the trees and the seed.
    settings = {"maxIter": 20, "maxDepth": 5, "seed": 42, **params}
    return Pipeline(stages=[assembler, GBTRegressor(featuresCol="features", labelCol=label, **settings)])


def metrics_of(predicted: DataFrame, label: str = TARGET) -> dict:
    return labels.regression_metrics(predicted, label, "prediction").first().asDict()


def train_gbt(
    train: DataFrame, validate: DataFrame, features: Sequence[str] = MODEL_FEATURES, label: str = TARGET, **params
) -> tuple[PipelineModel, dict]:
    """Fit on one period, report errors there and on the next."""
    model = gbt_pipeline(features, label, **params).fit(train)
    seen, ahead = metrics_of(model.transform(train), label), metrics_of(model.transform(validate), label)
    return model, {"train_rmse": seen["rmse"], "val_rmse": ahead["rmse"], "val_mae": ahead["mae"]}


def train_and_evaluate(
    raw: DataFrame,
    train: float = 0.7,
    validate: float = 0.15,
    production_rmse: float | None = None,
    baseline_min_improvement_pct: float = 0.0,
    tie: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    **params,
) -> dict:
    """Prepare, split in time, fit, gate against the baselines and production, back-test on the test period.

    The prepared rows are computed once and stored, so that every pass of the fit reads them, and a lost executor costs nothing.
    """
    spark = raw.sparkSession
    keep = list(dict.fromkeys([*(tie or []), *keep]))
    prepared = settled(labels.prepare_training(raw, tie, keep))
    train_df, validate_df, test_df = labels.split_times(prepared, train, validate, stored=True).parts(prepared)
    model, report = train_gbt(train_df, validate_df, **params)
    predicted = model.transform(test_df)
    report["test_rmse"] = metrics_of(predicted)["rmse"]
    report["zero_return_rmse"] = labels.zero_return_baseline(test_df).first()["rmse"]
    report["persistence_rmse"] = labels.persistence_baseline(test_df).first()["rmse"]
    report["production_rmse"] = production_rmse
    one = spark.createDataFrame(
        [(report["test_rmse"], report["zero_return_rmse"], production_rmse)],
        "test_rmse double, zero_return_rmse double, production_rmse double",
    )
    decision = labels.promotion_gate(one, min_baseline_pct=baseline_min_improvement_pct).first()
    report.update({c: decision[c] for c in ("beats_baseline", "beats_production", "promotable")})
    trades = predicted.select(
        "symbol", *tick_order(predicted, tie), F.col("prediction").alias("predicted_return"),
        F.col(TARGET).alias("realized_return"),
    )
    order = tick_order(trades, tie)
    report["backtest"] = backtest_summary(trades, (), [order[0], "symbol", *order[1:]]).first().asDict()
    report["model"] = model
    return report


def walk_forward_parts(df: DataFrame, n: int = 5, train: float = 0.7, compat: bool = False) -> DataFrame:
    """Number the chunks of the timeline and mark each row as train or val inside its chunk."""
    times = settled(df.select("event_ts"))  # all cut times come from this one column
    chunks_of_times = settled(labels.walk_forward_chunks(times, n, compat, times=times))
    chunked = labels.walk_forward_chunks(df, n, compat, times=times)
    part = F.lit("train")
    for i in range(n):
        split = labels.split_times(chunks_of_times.where(F.col("chunk") == i), train, 1 - train, stored=True)
        part = F.when((F.col("chunk") == i) & (split.label() != "train"), "val").otherwise(part)
    return chunked.withColumn("part", part)


def walk_forward_baselines(
    df: DataFrame, n: int = 5, train: float = 0.7, tie: Sequence[str] | None = None, compat: bool = False
) -> DataFrame:
    """Errors of both baselines on the val part of each chunk, all chunks in one job."""
    ahead = walk_forward_parts(df, n, train, compat).where(F.col("part") == "val")
    zero = labels.zero_return_baseline(ahead, ("chunk",)).select("chunk", F.col("n").alias("n_val"), F.col("rmse").alias("zero_return_rmse"))
    average = labels.moving_average_baseline(ahead, 5, tie, ("chunk",), ("chunk",)).select("chunk", F.col("rmse").alias("ma_rmse"))
    return zero.join(average, "chunk", "left")


def walk_forward_validate(
    df: DataFrame,
    n: int = 5,
    train: float = 0.7,
    features: Sequence[str] = MODEL_FEATURES,
    tie: Sequence[str] | None = None,
    compat: bool = False,
    parallel: int = 4,
    **params,
) -> list[dict]:
    """Fit one model per chunk and compare it with the baselines. Empty chunks are skipped.

    ``parallel`` chunks are worked on at a time, each as jobs in a scheduler pool of its own, over one stored table: the
    many short jobs of a fit leave most executors idle while one chunk is fitted alone.
    """
    spark = df.sparkSession
    parts = settled(walk_forward_parts(df, n, train, compat))
    chunks = sorted(r["chunk"] for r in parts.select("chunk").distinct().collect())  # n rows

    def fitted(i: int) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"walk-forward-{i}")
        chunk = parts.where(F.col("chunk") == i)
        ahead = chunk.where(F.col("part") == "val")
        _, report = train_gbt(chunk.where(F.col("part") == "train"), ahead, features, **params)
        zero = labels.zero_return_baseline(ahead).first()["rmse"]
        average = labels.moving_average_baseline(ahead, 5, tie).first()["rmse"]
        return {
            "window": i,
            "train_rmse": report["train_rmse"],
            "val_rmse": report["val_rmse"],
            "zero_return_rmse": zero,
            "ma_rmse": average,
            "beats_zero_return": report["val_rmse"] < zero,
            "beats_ma": report["val_rmse"] < average,
        }

    with ThreadPoolExecutor(max(1, parallel)) as workers:
        return list(workers.map(inheritable_thread_target(spark)(fitted), chunks))
