from __future__ import annotations

import math
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import START
from tickloom.functions.columns import smirnov_p_value
from tickloom.operators import drift
from tickloom.schemas import MODEL_FEATURES

SHAPES = [(0.001, 0.01), (0, 5), (1, 0.02), (1, 0.015), (1, 0.018), (0.005, 0.002)]


def sample(seed, n=500):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({c: rng.normal(m, s, n) for c, (m, s) in zip(MODEL_FEATURES, SHAPES)})


def frame(spark, pdf):
    return spark.createDataFrame(pdf)


def numpy_psi(reference, current):
    counts, edges = np.histogram(reference, bins=10)
    shares = [counts / len(reference), np.histogram(current, bins=edges)[0] / len(current)]
    a, b = (np.where(s == 0, 1e-10, s) for s in shares)
    return float(np.sum((b - a) * np.log(b / a)))


def numpy_ks(a, b):
    at = np.sort(np.concatenate([a, b]))
    return float(np.max(np.abs(np.searchsorted(np.sort(a), at, "right") / len(a) - np.searchsorted(np.sort(b), at, "right") / len(b))))


def one_feature(spark, reference, current):
    ref, cur = (spark.createDataFrame([("x", float(v)) for v in values], "feature string, value double") for values in (reference, current))
    return drift.value_counts(ref, cur)


@pytest.mark.parametrize("seed", [42, 99])
def test_no_drift_between_like_samples(spark, seed):
    rows = drift.feature_drift(frame(spark, sample(42)), frame(spark, sample(seed))).collect()
    assert len(rows) == 6 and not any(r["drifted"] for r in rows)
    for r in rows:
        a, b = sample(42)[r["feature"]].to_numpy(), sample(seed)[r["feature"]].to_numpy()
        assert r["psi"] == pytest.approx(numpy_psi(a, b), abs=1e-6) and r["ks_statistic"] == pytest.approx(numpy_ks(a, b))


def test_a_shifted_column_drifts_alone(spark):
    shifted = sample(42)
    shifted["price_return"] += 0.5
    rows = drift.feature_drift(frame(spark, sample(42)), frame(spark, shifted)).collect()
    assert [r["feature"] for r in rows if r["drifted"]] == ["price_return"]


@pytest.mark.parametrize("slice_rows", [None, 40])
def test_keys_share_one_reference(spark, sliced, slice_rows):
    if slice_rows:
        sliced(slice_rows)
    a, b = sample(1, 60), sample(2, 80)
    b["vwap_ratio"] += 1
    current = pd.concat([a.assign(symbol="A"), b.assign(symbol="B")])
    rows = drift.feature_drift(frame(spark, sample(42)), frame(spark, current), ("symbol",)).collect()
    for r in rows:
        mine = {"A": a, "B": b}[r["symbol"]][r["feature"]].to_numpy()
        reference = sample(42)[r["feature"]].to_numpy()
        assert r["psi"] == pytest.approx(numpy_psi(reference, mine), abs=1e-6)
        assert r["ks_statistic"] == pytest.approx(numpy_ks(reference, mine)) and r["n_cur"] == len(mine)
    summary = {r["symbol"]: r for r in drift.drift_summary(drift.feature_drift(frame(spark, sample(42)), frame(spark, current), ("symbol",))).collect()}
    assert "vwap_ratio" in [c["feature"] for c in summary["B"]["drifted_columns"]]
    assert summary["A"]["n_drifted"] == len(summary["A"]["drifted_columns"])


def test_psi_edge_cases(spark):
    values = np.random.default_rng(0).normal(size=400)
    assert drift.psi(one_feature(spark, values, values)).first()["psi"] == pytest.approx(0.0)
    far = np.random.default_rng(1).normal(3, 1, 400)
    assert drift.psi(one_feature(spark, values, far)).first()["psi"] > 0.5
    assert drift.psi(one_feature(spark, values, far)).first()["psi"] == pytest.approx(numpy_psi(values, far), abs=1e-6)
    assert drift.psi(one_feature(spark, [2.0] * 5, [2.0, 2.1, 9.0])).first()["psi"] == pytest.approx(numpy_psi([2.0] * 5, [2.0, 2.1, 9.0]), abs=1e-6)


def test_ks_with_ties(spark):
    a, b = [1, 1, 2, 2, 2, 3], [1, 2, 2, 5, 5]
    row = drift.ks(one_feature(spark, a, b)).first()
    assert row["ks_statistic"] == pytest.approx(numpy_ks(np.array(a), np.array(b))) and (row["n_ref"], row["n_cur"]) == (6, 5)
    same = drift.ks(one_feature(spark, a, a)).first()
    assert same["ks_statistic"] == 0 and same["ks_p_value"] == 1.0


def test_few_values_are_skipped_and_columns_are_shared(spark):
    ref = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, None, 2.0), (3.0, None, 2.0)], "a double, b double, c double")
    cur = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "a double, b double")
    assert drift.shared_columns(ref, cur) == ["a", "b"]
    assert [r["feature"] for r in drift.feature_drift(ref, cur).collect()] == ["a"]


def errors(spark, values):
    rows = [("A", START + timedelta(seconds=i), i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp, id long, realized_return_error double")


def test_concept_drift(spark):
    rng = np.random.default_rng(7)
    stable = rng.normal(0, 1, 100)
    assert not drift.concept_drift(errors(spark, np.tile(stable, 2))).first()["drifted"]
    jump = np.concatenate([rng.normal(0, 1, 50), rng.normal(5, 1, 50)])
    assert drift.concept_drift(errors(spark, jump)).first()["drifted"]
    assert drift.concept_drift(errors(spark, [1, 2, 3])).count() == 0
    odd = drift.concept_drift(errors(spark, [1, 2, 3, 4, 5])).first()
    assert (odd["n_ref"], odd["n_cur"]) == (2, 3)
    flipped = drift.concept_drift(errors(spark, jump), newest_is_reference=True).first()
    assert flipped["psi"] == pytest.approx(numpy_psi(jump[50:], jump[:50]), abs=1e-6)


def test_cooldown_and_state(spark):
    now = START + timedelta(hours=1)
    report = spark.createDataFrame([(s, s != "calm", False) for s in ("new", "recent", "edge", "old", "calm")], "symbol string, feature_drift boolean, concept_drift boolean")
    state = spark.createDataFrame(
        [("recent", now - timedelta(minutes=29)), ("edge", now - timedelta(minutes=30)), ("old", now - timedelta(minutes=31)), ("other", START)],
        "symbol string, last_trigger_time timestamp",
    )
    checked = drift.with_cooldown(report, state, F.lit(now))
    got = {r["symbol"]: (r["triggered"], r["cooldown_active"]) for r in checked.collect()}
    assert got == {"new": (True, False), "recent": (False, True), "edge": (True, False), "old": (True, False), "calm": (False, False)}
    after = drift.upsert_state(state, checked.where("triggered"))
    times = {r["symbol"]: r["last_trigger_time"] for r in after.collect()}
    assert len(times) == 5 and times["new"] == times["old"] and times["recent"] < times["old"] and times["other"] < times["recent"]
    assert drift.any_triggered(checked).first()["retrain"] is True
    assert drift.any_triggered(checked.where("symbol = 'calm'")).first()["retrain"] is False


@pytest.mark.parametrize("n", [10_000, 200_000, 100_000_000])
def test_nearly_equal_large_samples_do_not_drift(spark, n):
    p = spark.range(1).select(smirnov_p_value(F.lit(1.0 / n), F.lit(n), F.lit(n)).alias("p")).first()["p"]
    assert p == pytest.approx(1.0)


def test_p_value_where_the_series_meet(spark):
    xs = [0.3, 0.6, 1.0, 1.17, 1.18, 1.19, 1.5, 2.5]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select(smirnov_p_value(F.col("x"), F.lit(2), F.lit(2)).alias("p")).collect()
    for x, row in zip(xs, rows):
        want = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 2000))
        assert row["p"] == pytest.approx(want, abs=1e-12)


def test_symbols_with_errors_only_are_reported(spark):
    features = spark.createDataFrame([("A", "f", 0.1, 0.1, 0.9, False)], "symbol string, feature string, psi double, ks_statistic double, ks_p_value double, drifted boolean")
    concept = spark.createDataFrame([("B", True)], "symbol string, drifted boolean")
    got = {r["symbol"]: tuple(r)[1:] for r in drift.drift_summary(features, concept).collect()}
    assert got == {"A": (False, 0, [], False), "B": (False, 0, [], True)}
