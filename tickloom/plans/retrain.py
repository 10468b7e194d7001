"""The retrain job: drift check, training on the raw lake, gate, promotion, new reference sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import drift, predictions
from tickloom.operators.features import tick_features
from tickloom.operators.versions import VersionLog, production_version
from tickloom.plans.training import train_and_evaluate
from tickloom.sources import lake
from tickloom.sources.scratch import settled

MODEL_NAME = "tick_return_gbt"
STATE_SCHEMA = "symbol string, last_trigger_time timestamp"


def read_drift_state(spark: SparkSession, path: str) -> DataFrame:
    stored = lake.read_version(spark, path, STATE_SCHEMA)
    return spark.createDataFrame([], STATE_SCHEMA) if stored is None else stored


def write_drift_state(state: DataFrame, path: str) -> None:
    """Replace the state table; a crash leaves the old or the new one."""
    lake.write_version(state.coalesce(1), path)


def check_drift(
    spark: SparkSession, reference_path: str, stored: DataFrame, state_path: str, now: Column, minutes: int = 30, recent: int = 500
) -> DataFrame | None:
    """Report per symbol and updated cooldown state; None while there is no reference sample."""
    reference = lake.read_reference(spark, reference_path)
    if reference is None:
        return None
    state = read_drift_state(spark, state_path)
    report = settled(
        drift.drift_report(
            reference,
            predictions.recent_feature_rows(stored, recent),
            predictions.recent_return_errors(stored, recent),
            state,
            now,
            minutes,
        )
    )
    write_drift_state(drift.upsert_state(state, report.where(F.col("triggered"))), state_path)
    return report


def retrain_if_drift(
    spark: SparkSession,
    raw_lake: str,
    prediction_table: str,
    reference_path: str,
    state_path: str,
    version_path: str,
    now: Column | None = None,
    model_name: str = MODEL_NAME,
    force: bool = False,
    canary: bool = False,
    tie: Sequence[str] | None = None,
    *,
    model_path: str,
    **params,
) -> dict:
    """Run the whole job; ``force`` trains without a drift trigger, e.g. for the first model.

    Training starts from the raw lake and prepares it once. The model is saved below ``model_path`` before
    it can be promoted. The reference sample follows the deployed model, so it is replaced on promotion only.
    """
    if not force:
        stored = predictions.read_predictions(spark, prediction_table)
        report = check_drift(spark, reference_path, stored, state_path, F.current_timestamp() if now is None else now)
        if report is None or not drift.any_triggered(report).first()["retrain"]:
            return {"status": "no_drift"}
    raw = lake.read_lake(spark, raw_lake)
    log = VersionLog(spark, version_path)
    trained = train_and_evaluate(raw, production_rmse=log.production_rmse(model_name), tie=tie, **params)

    def save(version: int) -> str:
        place = f"{model_path.rstrip('/')}/{model_name}/{version}"
        trained["model"].write().overwrite().save(place)
        return place

    result = log.gate(model_name, trained, canary, save)
    if result["status"] == "promoted":
        lake.write_reference(drift.reference_sample(tick_features(raw, tie)), reference_path)
    return {**result, "training": {k: v for k, v in trained.items() if k != "model"}}


def production_model(spark: SparkSession, version_path: str, model_name: str = MODEL_NAME) -> tuple[PipelineModel, int] | None:
    """The model in production and its version, or None while there is none."""
    log = VersionLog(spark, version_path)
    row = production_version(log.read().where(F.col("model") == model_name)).select("version").first()
    if row is None:
        return None
    return PipelineModel.load(log.tags(model_name, row["version"])["location"]), row["version"]
