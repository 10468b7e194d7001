"""Checkpointed stream writers."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.operators.ingest import accepted, rejected, to_messages, validate_events
from tickloom.sources.lake import append_batch


def _start(writer: DataStreamWriter, trigger_seconds: int | None, available_now: bool) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds is not None:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def write_lake_stream(
    df: DataFrame, base: str, checkpoint: str, trigger_seconds: int | None = 30, available_now: bool = False
) -> StreamingQuery:
    """Append a stream to the lake. ``trigger_seconds=None`` starts each micro-batch right after the last.

    Micro-batches become plain files of the lake, one per directory unless it is large, so that batch
    writers, compaction and retention may work on it as well. A micro-batch that is tried again is not
    stored twice. Compact a lake only while its stream has no micro-batch to try again.
    """
    batches = checkpoint.rstrip("/") + "/lake_batches"

    def append(rows: DataFrame, number: int) -> None:
        append_batch(rows, base, batches, number)

    return _start(df.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint), trigger_seconds, available_now)


def write_decoded_stream(
    df: DataFrame, base: str, dead_letters: str, checkpoint: str, trigger_seconds: int | None = 30, available_now: bool = False
) -> StreamingQuery:
    """Messages from ``decode_events``: good events to the lake, all others with payload and reason to ``dead_letters``.

    A micro-batch is decoded once for both. Its dead letters lie in a folder of its number, which a second try replaces, and
    are there before its events, so that a message is in one of the two places when the batch is done, and once.
    """
    batches = checkpoint.rstrip("/") + "/lake_batches"

    def store(rows: DataFrame, number: int) -> None:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected(rows).write.mode("overwrite").parquet(f"{dead_letters.rstrip('/')}/batch={number}")
            append_batch(validate_events(accepted(rows).drop("payload")), base, batches, number)
        finally:
            rows.unpersist()

    return _start(df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), trigger_seconds, available_now)


write_raw_stream = write_lake_stream
write_features_stream = write_lake_stream


def run_stream(df: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Append a stream to a plain Parquet directory; its checkpoint lies beside the data, not in it."""
    writer = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint or path.rstrip("/") + "_checkpoint")
    )
    return _start(writer, None, available_now)


def write_messages_stream(df: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Publish events keyed by symbol. Delivery settings are those of an idempotent producer."""
    writer = (
        to_messages(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.retries", "5")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return writer.start()
