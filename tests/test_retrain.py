from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import START, ticks
from tickloom.operators import features, labels, predictions
from tickloom.operators.ingest import validate_events
from tickloom.operators.versions import PRODUCTION, STAGING, VersionLog, stage_fold
from tickloom.plans import retrain
from tickloom.sources import lake

SMALL = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture
def paths(tmp_path):
    return {k: str(tmp_path / k) for k in ("raw_lake", "prediction_table", "reference_path", "state_path", "version_path", "model_path")}


def zigzag(spark, n=400):
    """Prices that swing between two levels: easy to predict, so a model passes the gate."""
    rnd = random.Random(1)
    return ticks(spark, [("A", (100 if i % 2 else 110) + rnd.uniform(0, 0.1), 10, i) for i in range(n)])


def store_predictions(spark, paths, shift=0.0):
    rows = features.tick_features(zigzag(spark))
    scored = labels.moving_average_prediction(rows, 5, [], "predicted_return").where("predicted_return is not null")
    stored = predictions.prediction_rows(scored.withColumn("n", F.unix_seconds("event_ts")), "n")
    stored = stored.withColumn("price_return", F.col("price_return") + shift)
    predictions.save_predictions(predictions.realize_fifo(stored, validate_events(zigzag(spark)), ["idempotency_key"]), paths["prediction_table"])


def test_whole_job(spark, paths):
    now = F.lit(START + timedelta(days=1))
    lake.write_raw_batch(validate_events(zigzag(spark)), paths["raw_lake"])
    store_predictions(spark, paths)
    # Without a reference sample there is nothing to compare with.
    assert retrain.retrain_if_drift(spark, **paths, now=now, **SMALL)["status"] == "no_drift"
    first = retrain.retrain_if_drift(spark, **paths, now=now, force=True, **SMALL)
    assert first["status"] == "promoted" and first["training"]["beats_baseline"]
    assert lake.read_reference(spark, paths["reference_path"]).count() > 10
    model, version = retrain.production_model(spark, paths["version_path"])
    rows = features.tick_features(zigzag(spark))
    assert version == 1 and predictions.score(model, rows, version, 0.01).count() == 400

    # The live features have moved away from the reference: drift, but the same model is no improvement by 1 percent.
    store_predictions(spark, paths, shift=0.5)
    log = VersionLog(spark, paths["version_path"])
    second = retrain.retrain_if_drift(spark, **paths, now=now, **SMALL)
    assert second["status"] in ("promoted", "staging_only")
    state = {r["symbol"]: r["last_trigger_time"] for r in retrain.read_drift_state(spark, paths["state_path"]).collect()}
    assert state == {"A": (START + timedelta(days=1))}
    stages = [r["stage"] for r in stage_fold(log.read()).orderBy("version").collect()]
    assert len(stages) == 2 and PRODUCTION in stages

    # Within the cooldown nothing happens again.
    soon = F.lit(START + timedelta(days=1, minutes=5))
    assert retrain.retrain_if_drift(spark, **paths, now=soon, **SMALL)["status"] == "no_drift"


def test_a_model_that_loses_stays_in_staging(spark, paths):
    rnd = random.Random(2)
    noise = ticks(spark, [("A", 100 + rnd.gauss(0, 1e-6) + i * 0.0, 10, i) for i in range(200)])
    lake.write_raw_batch(validate_events(noise), paths["raw_lake"])
    VersionLog(spark, paths["version_path"]).promote(retrain.MODEL_NAME, VersionLog(spark, paths["version_path"]).register(retrain.MODEL_NAME, 1e-12))
    result = retrain.retrain_if_drift(spark, **paths, force=True, **SMALL)
    assert result["status"] == "staging_only" and lake.read_reference(spark, paths["reference_path"]) is None
    assert stage_fold(VersionLog(spark, paths["version_path"]).read()).where(F.col("stage") == STAGING).count() == 1


def test_a_model_that_cannot_be_saved_is_not_promoted(spark, paths, tmp_path):
    lake.write_raw_batch(validate_events(zigzag(spark)), paths["raw_lake"])
    (tmp_path / "model_path").write_text("a file where the folder should be")
    with pytest.raises(Exception):
        retrain.retrain_if_drift(spark, **paths, force=True, **SMALL)
    assert retrain.production_model(spark, paths["version_path"]) is None and lake.read_reference(spark, paths["reference_path"]) is None
