from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from helpers import tick, ticks
from tickloom.operators import ingest
from tickloom.schemas import MARKET_EVENT
from tickloom.sources.ticks import ticks_from_rows

FLAT = {"e": "trade", "s": "BTCUSDT", "p": "118420.52", "q": "0.42", "T": 1690886434000}
NESTED = {"type": "trade", "data": [{"s": "BINANCE:BTCUSDT", "p": 118420.52, "v": 0.42, "t": 1690886434000}, {"s": "BINANCE:ETHUSDT", "p": 2, "v": 3, "t": 1690886434500}]}
NORMAL = {"symbol": "X", "price": 1.5, "volume": 2, "timestamp": "2026-08-01T00:00:00Z"}
EXPECTED = ("BTCUSDT", 118420.52, 0.42, "2023-08-01T10:40:34Z", None)
FIELDS = ["symbol", "price", "volume", "timestamp", "reject_reason"]


def payloads(spark, *values, source="binance"):
    rows = [(i, source, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, source string, payload string")


def got(df):
    return [tuple(r) for r in df.orderBy("i").select(*FIELDS).collect()]


@pytest.mark.parametrize("adapt", [ingest.adapt_flat_trades, ingest.adapt_trades])
def test_flat_trades(spark, adapt):
    rows = got(adapt(payloads(spark, FLAT, NORMAL, {"s": "A", "p": "1"}, {**FLAT, "p": "abc"}, "[1]", "{oops", {**FLAT, "s": ""})))
    assert rows[0] == EXPECTED
    assert rows[1] == ("X", 1.5, 2.0, "2026-08-01T00:00:00Z", None)
    assert [r[-1] for r in rows[2:]] == [
        "missing trade fields", "not a number", "not a JSON object", "not a JSON object", "missing trade fields",
    ]


@pytest.mark.parametrize("adapt", [ingest.adapt_nested_trades, ingest.adapt_trades])
def test_nested_trades_use_the_first_one(spark, adapt):
    rows = got(adapt(payloads(spark, NESTED, {"data": []}, {"type": "ping"}, NORMAL, source="finnhub")))
    assert rows[0] == EXPECTED
    assert [r[-1] for r in rows[1:]] == ["missing trade fields", "missing trade fields", None]


def test_nested_trades_can_all_be_used(spark):
    rows = ingest.adapt_nested_trades(payloads(spark, NESTED, {"data": []}), explode_all=True).collect()
    assert sorted(r["symbol"] for r in rows if r["symbol"]) == ["BTCUSDT", "ETHUSDT"]
    assert {r["timestamp"] for r in rows if r["symbol"] == "ETHUSDT"} == {"2023-08-01T10:40:34.500000Z"}
    assert sum(r["reject_reason"] is not None for r in rows) == 1


def test_unknown_source_must_send_normal_events(spark):
    rows = got(ingest.adapt_trades(payloads(spark, NORMAL, FLAT, source="other")))
    assert [r[-1] for r in rows] == [None, "missing trade fields"]


def test_normalize_adds_metadata_and_reasons(spark):
    df = spark.createDataFrame(
        [("A", "1.5", "2", "t1"), ("A", "-1", "2", "t1"), ("A", "x", "2", "t1"), (None, "1", "2", "t1"), ("A", "1", "-2", "t1"), ("A", "1", "0", ""), ("A", "NaN", "0", "t")],
        "symbol string, price string, volume string, timestamp string",
    )
    rows = ingest.normalize_events(df, "feed").collect()
    assert rows[0]["idempotency_key"] == "A-t1-feed" and rows[0]["source"] == "feed" and rows[0]["received_at"].endswith("Z")
    assert [r["reject_reason"] for r in rows] == [
        None, "price or volume out of range", "not a number", "missing fields",
        "price or volume out of range", "empty timestamp", "price or volume out of range",
    ]
    assert ingest.accepted(ingest.normalize_events(df)).count() == 1
    assert ingest.rejected(ingest.normalize_events(df)).count() == 6


def test_bad_json_becomes_nulls_and_is_dropped(spark):
    good = dict(zip(MARKET_EVENT.names, tick("A", 1, 2, 0)))
    df = spark.createDataFrame([(json.dumps(good),), ("{oops",)], "value string")
    parsed = ingest.parse_ticks_json(df)
    assert parsed.count() == 2 and parsed.columns == MARKET_EVENT.names
    assert [r["symbol"] for r in ingest.validate_events(parsed).collect()] == ["A"]


def test_messages_round_trip(spark):
    df = ticks(spark, [("A", 1, 2, 0)])
    row = ingest.to_messages(df).first()
    assert row["key"] == "A" and tuple(json.loads(row["value"]).values()) == tuple(df.first())


def test_validation_keeps_only_sound_rows(spark):
    rows = [tick("A", 1, 0, 0), tick("A", 0, 1, 0), tick("A", 1, -1, 0), tick("A", float("nan"), 1, 0), tick("A", 1, 1, "not a time"), tick("A", 1, 1, "2026-08-01T00:00:00.5+02:00")]
    valid = ingest.validate_events(ticks_from_rows(spark, rows)).collect()
    assert len(valid) == 2
    assert ingest.validate_events(ticks_from_rows(spark, rows)).where(F.col("event_ts") == F.lit("2026-07-31 22:00:00.5").cast("timestamp")).count() == 1


def test_dedup_keeps_the_earliest_even_with_many_copies(spark):
    rows = [tick("A", 1, 1, i, key="same") for i in range(50)] + [tick("B", 2, 1, 0)]
    kept = ingest.validate_training_data(ticks_from_rows(spark, rows)).collect()
    assert sorted((r["symbol"], r["timestamp"]) for r in kept) == [("A", "2026-08-01T00:00:00"), ("B", "2026-08-01T00:00:00")]
