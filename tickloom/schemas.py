"""Column layouts of the tables this library reads and writes."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names and types of the data model, here and in the layouts below.
MARKET_EVENT = StructType(
    [
        StructField("symbol", StringType(), False),
        StructField("price", DoubleType(), False),
        StructField("volume", DoubleType(), False),
        StructField("timestamp", StringType(), False),
        StructField("source", StringType(), False),
        StructField("idempotency_key", StringType(), False),
        StructField("received_at", StringType(), False),
    ]
)

# Names of the derived tick columns, in output order.
TICK_DERIVED = [
    "price_change",
    "price_return",
    "volume_change",
    "ma5",
    "ma20",
    "vwap",
    "price_range",
    "ma5_ratio",
    "ma20_ratio",
    "vwap_ratio",
    "price_range_ratio",
]
TICK_BASE = ["symbol", "event_ts", "price", "volume"]
TICK_FEATURES = TICK_BASE + TICK_DERIVED

# The features a model may see: all relative to the current price or to the previous tick.
MODEL_FEATURES = [
    "price_return",
    "volume_change",
    "ma5_ratio",
    "ma20_ratio",
    "vwap_ratio",
    "price_range_ratio",
]

FEATURE_ROW = StructType(
    [
        StructField("symbol", StringType(), False),
        StructField("event_ts", TimestampType(), False),
        StructField("price", DoubleType(), False),
        StructField("volume", DoubleType(), False),
    ]
    + [StructField(name, DoubleType(), True) for name in TICK_DERIVED]
)

STREAM_STATE = StructType(
    [
        StructField("prices", ArrayType(DoubleType()), False),
        StructField("volumes", ArrayType(DoubleType()), False),
    ]
)

LAKE_PARTITIONS = ["year", "month", "day", "symbol"]
LAKE_PARTITION_FIELDS = [
    StructField("year", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("day", IntegerType(), True),
    StructField("symbol", StringType(), True),
]

REALIZED_AT = "realized_at"  # when the price that realized a prediction came; beside the columns below

PREDICTION = StructType(
    [
        StructField("id", LongType(), False),
        StructField("timestamp", TimestampType(), False),
        StructField("symbol", StringType(), False),
        StructField("current_price", DoubleType(), False),
        StructField("predicted_price", DoubleType(), False),
        StructField("predicted_return", DoubleType(), False),
        StructField("model_version", StringType(), False),
        StructField("realized_error", DoubleType(), True),
        StructField("realized_return_error", DoubleType(), True),
    ]
    + [StructField(name, DoubleType(), True) for name in MODEL_FEATURES]
)

STORED_PREDICTION = StructType(PREDICTION.fields + [StructField(REALIZED_AT, TimestampType(), True)])
