"""Accuracy of predictions while they come true."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.predictions import accuracy


def running_accuracy(realized: DataFrame) -> DataFrame:
    """RMSE, MAE, return RMSE and directional accuracy so far per symbol; write it in update mode."""
    return accuracy(realized)


def show_running_accuracy(realized: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Keep the current accuracy in an in-memory table, one row per symbol."""
    writer = running_accuracy(realized).writeStream.outputMode("complete").format("memory").queryName(name)
    return writer.option("checkpointLocation", checkpoint).start()
