"""Tick sources: message log, files, generator, rows in memory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ingest import parse_ticks_json
from tickloom.schemas import MARKET_EVENT


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int | None = 1_000_000, starting: str = "latest"
) -> DataFrame:
    """Subscribe to a topic. The limit per trigger bounds a micro-batch; the connector must be on the classpath."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def kafka_ticks(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Market events of a topic, decoded; broken messages are rows of NULLs that validation drops.

    ``decode_events`` over ``kafka_messages`` keeps them, for ``write_decoded_stream``.
    """
    return parse_ticks_json(kafka_messages(spark, servers, topic, **options))


def json_file_ticks(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Market events from a directory of JSON-lines text files, as a stream."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return parse_ticks_json(lines)


def parquet_ticks(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def generated_ticks(spark: SparkSession, rows_per_second: int = 10, symbols: int = 3) -> DataFrame:
    """Endless made-up ticks for trying out a stream."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    symbol = (F.col("value") % symbols).cast("string")
    return rate.select(
        symbol.alias("symbol"),
        F.col("value").cast("double").alias("price"),
        (F.col("value") * 10).cast("double").alias("volume"),
        text.alias("timestamp"),
        F.lit("rate").alias("source"),
        F.concat_ws("-", symbol, text, F.lit("rate")).alias("idempotency_key"),
        text.alias("received_at"),
    )


def ticks_from_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), MARKET_EVENT)


def feature_stream(ticks: DataFrame, **options) -> DataFrame:
    """Ticks of any streaming source to feature rows."""
    from tickloom.streaming.features import stream_tick_features

    return stream_tick_features(ticks, **options)
