from __future__ import annotations

from datetime import timedelta

import pytest

from helpers import START
from tickloom.operators import monitor
from tickloom.operators.versions import ARCHIVED, PRODUCTION, STAGING, VersionLog, production_version, stage_fold


def log(spark, rows):
    return spark.createDataFrame(
        [(START + timedelta(seconds=at), s, status, kind, float(latency)) for at, s, status, kind, latency in rows],
        "ts timestamp, symbol string, status string, error_type string, latency_s double",
    )


def test_rates(spark):
    df = log(spark, [(0, "A", "ok", None, 0.1), (59, "A", "ok", None, 0.1), (60, "A", "error", "model_error", 0.1)])
    assert sorted((r["status"], r["rate"]) for r in monitor.request_rate(df).collect()) == [("error", 1 / 60), ("ok", 2 / 60)]
    assert [r["error_type"] for r in monitor.error_rate_by_type(df).collect()] == ["model_error"]


def test_histogram_quantiles(spark):
    df = log(spark, [(i % 60, "A", "ok", None, v) for i, v in enumerate([0.2] * 50 + [0.7] * 45 + [9.0] * 5)])
    row = monitor.latency_quantiles(df).first()
    assert row["p50"] == pytest.approx(0.25) and row["p95"] == pytest.approx(1.0) and row["p99"] == 5.0
    counts = {r["le"]: r["requests"] for r in monitor.latency_histogram(df).collect()}
    assert counts["0.25"] == 50 and counts["0.5"] == 50 and counts["1.0"] == 95 and counts["+Inf"] == 100


def test_latency_alert_needs_five_minutes(spark):
    # One slow request keeps the 5-minute range slow for 10 steps, 4.5 minutes: not long enough alone.
    assert monitor.latency_alerts(log(spark, [(0, "A", "ok", None, 2.0)])).count() == 0
    row = monitor.latency_alerts(log(spark, [(0, "A", "ok", None, 2.0), (45, "A", "ok", None, 2.0), (0, "B", "ok", None, 0.1)])).first()
    assert row["symbol"] == "A" and row["pending_since"] == (START + timedelta(seconds=30)).replace(tzinfo=None)
    assert row["firing_since"] - row["pending_since"] == timedelta(minutes=5)


def test_error_ratio_alert(spark):
    good = [(10 * i, "A", "ok", None, 0.1) for i in range(120)]
    assert monitor.error_ratio_alerts(log(spark, good)).count() == 0
    bad = [(10 * i, "A", "error" if i % 10 == 0 else "ok", None, 0.1) for i in range(120)]
    assert monitor.error_ratio_alerts(log(spark, bad)).count() == 1


def test_rmse_alert_holds_between_updates(spark):
    def realized(rows):
        return spark.createDataFrame([("A", START + timedelta(seconds=at), e) for at, e in rows], "symbol string, timestamp timestamp, realized_return_error double")

    assert monitor.rmse_alerts(realized([(0, 0.05), (200, 0.0), (210, 0.0), (220, 0.0), (230, 0.0), (235, 0.0), (236, 0.0)])).count() == 0
    assert monitor.rmse_alerts(realized([(0, 0.05), (400, 0.0), (401, 0.0), (402, 0.0), (403, 0.0), (404, 0.0), (405, 0.0)])).count() == 1


def test_health_bands(spark):
    df = spark.createDataFrame([("A", 99.9, 50.0), ("B", 100.0, 200.0), ("C", 500.0, None)], "symbol string, rmse double, mae double")
    got = {r["symbol"]: (r["rmse_band"], r["mae_band"]) for r in monitor.health_bands(df).collect()}
    assert got == {"A": ("green", "yellow"), "B": ("yellow", "red"), "C": ("red", None)}


def test_version_log(spark, tmp_path):
    versions = VersionLog(spark, str(tmp_path / "versions"))
    assert versions.production_rmse("m") is None
    first = versions.register("m", 0.5, beats_baseline=True)
    assert first == 1 and versions.production_rmse("m") is None
    assert versions.tags("m", 1) == {"beats_baseline": "True"}
    versions.promote("m", 1)
    assert versions.production_rmse("m") == 0.5
    report = {"test_rmse": 0.4, "beats_baseline": True, "promotable": True}
    assert versions.gate("m", report, canary=True) == {"model": "m", "version": 2, "status": "promoted", "promotable": True}
    assert versions.gate("m", {**report, "promotable": False})["status"] == "staging_only"
    stages = {r["version"]: r["stage"] for r in stage_fold(versions.read()).collect()}
    assert stages == {1: ARCHIVED, 2: PRODUCTION, 3: STAGING}
    assert versions.tags("m", 2)["canary"] == "false" and versions.tags("m", 2)["test_rmse"] == "0.4"
    assert production_version(versions.read()).first()["version"] == 2
    versions.promote("m", 1)  # roll back
    assert versions.production_rmse("m") == 0.5
    with pytest.raises(ValueError):
        versions.promote("m", 77)
