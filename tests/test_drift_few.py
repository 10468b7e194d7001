"""A large reference against few current values: the same results as by sorting both sides, without storing or sorting it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tickloom.operators import drift, ordered
from tickloom.schemas import MODEL_FEATURES


def sides(spark, n_reference, n_current):
    """Values with many ties, nulls, NaN, zeros of both signs and a column of one side that is empty."""
    rng = np.random.default_rng(5)

    def made(n, shift):
        pdf = pd.DataFrame({c: np.round(rng.normal(shift, 1 + i, n), 1) for i, c in enumerate(MODEL_FEATURES)})
        pdf.loc[::7, "volume_change"] = np.nan
        pdf.loc[::5, "ma5_ratio"] = -0.0
        pdf.loc[1::5, "ma5_ratio"] = 0.0
        pdf.loc[::11, "vwap_ratio"] = np.inf
        return pdf

    reference, current = made(n_reference, 0), pd.concat([made(n_current, k / 4).assign(symbol=s) for k, s in enumerate("ABC")])
    current["ma20_ratio"] = np.nan
    return spark.createDataFrame(reference), spark.createDataFrame(current)


@pytest.mark.parametrize("slices", [None, 7])
def test_few_values_equal_sorting(spark, monkeypatch, sliced, slices):
    if slices:
        sliced(slices)
    reference, current = sides(spark, 700, 60)
    order = ["symbol", "feature"]
    few = drift.feature_drift(reference, current, ("symbol",)).orderBy(*order).collect()
    monkeypatch.setattr(drift, "FEW", 5)
    sorted_ = drift.feature_drift(reference, current, ("symbol",)).orderBy(*order).collect()
    assert few == sorted_ and len(few) == 15


def test_the_reference_is_neither_stored_nor_sorted(spark, monkeypatch):
    stored = []

    def settled(df, path=None, real=drift.settled):
        made = real(df, path)
        stored.append(made.count())
        return made

    monkeypatch.setattr(drift, "settled", settled)
    monkeypatch.setattr(ordered, "settled", settled)
    reference, current = sides(spark, 3000, 10)
    assert drift.feature_drift(reference, current, ("symbol",)).count() == 15
    assert max(stored) < 1000
