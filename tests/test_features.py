from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import rising, ticks
from tickloom.operators import features, labels, time_windows
from tickloom.schemas import TICK_FEATURES


def brute(rows):
    """Tick features by plain loops."""
    out, history = [], {}
    for symbol, price, volume, at in sorted(rows, key=lambda r: r[3]):
        past = history.setdefault(symbol, [])
        before = past[-1] if past else None
        past.append((price, volume))
        last5, last20 = past[-5:], past[-20:]
        traded = sum(v for _, v in last20)
        out.append(
            {
                "symbol": symbol, "price": price, "volume": volume, "at": at,
                "price_change": price - before[0] if before else None,
                "price_return": (price - before[0]) / before[0] if before else None,
                "volume_change": volume - before[1] if before else None,
                "ma5": sum(p for p, _ in last5) / len(last5),
                "ma20": sum(p for p, _ in last20) / len(last20),
                "vwap": sum(p * v for p, v in last20) / traded if traded > 0 else None,
                "price_range": max(p for p, _ in last20) - min(p for p, _ in last20),
            }
        )
    for row in out:
        for c in ("ma5", "ma20", "vwap", "price_range"):
            row[f"{c}_ratio"] = None if row[c] is None else row[c] / row["price"]
    return out


def random_ticks(n=300, seed=3):
    rnd = random.Random(seed)
    return [(rnd.choice(["hot", "hot", "a", "b"]), rnd.uniform(50, 60), float(rnd.choice([0, 0, 1, 5])), i) for i in range(n)]


def assert_features(df, rows):
    got = {(r["symbol"], r["price"]): r for r in df.collect()}
    want = brute(rows)
    assert len(got) == len(want)
    for row in want:
        mine = got[row["symbol"], row["price"]]
        for c in TICK_FEATURES[4:]:
            assert mine[c] == (None if row[c] is None else pytest.approx(row[c], abs=1e-9)), (c, row)


@pytest.mark.parametrize("slice_rows", [None, 10, 60])
def test_tick_features_equal_plain_loops(spark, sliced, slice_rows):
    if slice_rows:
        sliced(slice_rows)
    rows = random_ticks()
    assert_features(features.compute_features(ticks(spark, rows), "batch"), rows)


def test_schema_order_and_mode(spark):
    df = features.compute_features(ticks(spark, [("A", 1, 0, 0)]), mode="batch")
    assert df.columns == TICK_FEATURES
    row = df.first()
    assert row["vwap"] is None and row["price_return"] is None and row["ma20"] == 1.0
    with pytest.raises(ValueError):
        features.compute_features(df, mode="other")


def test_one_sort_serves_features_and_label(spark):
    plan = labels.prepare_training(rising(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol") == 1
    assert plan.count("Exchange") == 2  # the other one removes duplicates


def test_windows_match_pandas(spark):
    rows = [("A", 100 + i % 7, 1 + i % 3, 20 * i) for i in range(90)]
    got = time_windows.time_window_features(ticks(spark, rows)).orderBy("window.start").collect()
    frame = pd.DataFrame(rows, columns=["s", "p", "v", "t"])
    for row in got:
        end = int(row["window"]["end"].timestamp()) - int(got[0]["window"]["start"].timestamp())
        inside = frame[(frame.t >= end - 60) & (frame.t < end)]
        assert row["first_price"] == inside.p.iloc[0] and row["last_price"] == inside.p.iloc[-1]
        assert row["volume_sum"] == inside.v.sum()
        for name, seconds in (("ma5", 300), ("ma20", 1200)):
            mean = frame[(frame.t >= end - seconds) & (frame.t < end)].p.mean()
            assert row[name] == pytest.approx(mean) and row[f"{name}_ratio"] == pytest.approx(mean / row["last_price"])


def test_sliding_mean_equals_sparks_sliding_window(spark):
    df = ticks(spark, [("A", 100 + i, 1, 37 * i) for i in range(40)])
    mine = time_windows.sliding_mean(df, "5 minutes", "1 minute")
    valid = df.withColumn("event_ts", F.try_to_timestamp("timestamp"))
    spark_own = valid.groupBy(F.window("event_ts", "5 minutes", "1 minute").alias("window"), "symbol").agg(F.avg("price").alias("mean_price"))
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, spark_own.collect()))


def test_window_must_divide_the_horizons(spark):
    with pytest.raises(ValueError):
        time_windows.time_window_features(rising(spark), "7 minutes")
