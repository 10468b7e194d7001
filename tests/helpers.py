"""Small inputs used by several tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from tickloom.schemas import MARKET_EVENT, PREDICTION

START = datetime(2026, 8, 1)


def tick(symbol, price, volume, at, key=None):
    text = at if isinstance(at, str) else (START + timedelta(seconds=at)).isoformat()
    return (symbol, float(price), float(volume), text, "feed", key or f"{symbol}-{text}-feed", text)


def ticks(spark, rows):
    return spark.createDataFrame([tick(*r) for r in rows], MARKET_EVENT)


def rising(spark, n=20):
    """Price 100, 101, ... one second apart."""
    return ticks(spark, [("BTCUSDT", 100 + i, 10, i) for i in range(n)])


def prediction(id, symbol, at, current, predicted_price, predicted_return, error=None, return_error=None):
    when = START + timedelta(seconds=at)
    return (id, when, symbol, float(current), float(predicted_price), float(predicted_return), "v1", error, return_error) + (None,) * 6


def predictions(spark, rows):
    return spark.createDataFrame([prediction(*r) for r in rows], PREDICTION)
