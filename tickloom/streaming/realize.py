"""Predictions met by the prices that come after them, on streams: the same pairs as the batch forms give."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tickloom.streaming.features import HELD, in_order

REALIZED = (
    "id long, symbol string, timestamp timestamp, actual_price double, realized_error double, "
    "realized_return_error double, realized_at timestamp"
)
_LINE = ["_at", "_side", "_id", "_due", "_price", "_predicted", "_return"]
_WAITS = ["_id", "_at", "_due", "_price", "_predicted", "_return"]


def _meet(columns: Sequence[str], fifo: bool, give_up_us: int | None):
    """State function: rows of a symbol in order of time; prices meet the predictions that wait.

    First in, first out: a price realizes the oldest one alone. As of: it realizes all that are due.
    """
    order = ["_at", "_side", "_id", *columns[len(_LINE) :]]

    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = [list(part) for part in state.get] if state.exists else [[] for _ in [*columns, *_WAITS]]
        queue = list(zip(*kept[len(columns) :]))
        ready, held = in_order(columns, order, kept[: len(columns)], batches, state)
        found, start = [], 0
        for row in ready.itertuples(index=False, name=None):
            at, side, number, due, price, predicted, returned = row[: len(_LINE)]
            if side == 1:
                queue.append((number, at, due, price, predicted, returned))
                continue
            while start < len(queue) and (fifo or queue[start][2] <= at):
                waiting = queue[start]
                start += 1
                found.append((waiting, price, at))
                if fifo:
                    break
        queue = queue[start:]
        if give_up_us is not None:
            oldest = state.getCurrentWatermarkMs() * 1000 - give_up_us
            queue = [w for w in queue if w[1] >= oldest]
        if found:
            yield pd.DataFrame(
                {
                    "id": [w[0] for w, _, _ in found],
                    "symbol": key[0],
                    "timestamp": pd.to_datetime([w[1] for w, _, _ in found], unit="us"),
                    "actual_price": [price for _, price, _ in found],
                    "realized_error": [price - w[4] for w, price, _ in found],
                    "realized_return_error": [(price - w[3]) / w[3] - w[5] for w, price, _ in found],
                    "realized_at": pd.to_datetime([at for _, _, at in found], unit="us"),
                }
            )
        waits = [list(part) for part in zip(*queue)] if queue else [[] for _ in _WAITS]
        if not queue and held.empty:
            state.remove()
            return
        state.update((*(held[c].tolist() for c in columns), *waits))
        if len(held):
            state.setTimeoutTimestamp(-(-int(held["_at"].iloc[0]) // 1000))
        elif give_up_us is not None:
            state.setTimeoutTimestamp(max(-(-(queue[0][1] + give_up_us) // 1000), state.getCurrentWatermarkMs() + 1))

    return step


def _joined(predictions: DataFrame, prices: DataFrame, late_after: str, tie: Sequence[str], horizon: str, fifo: bool, give_up: str | None) -> DataFrame:
    zero, nothing = horizon.split()[0] in ("0", "0.0"), F.lit(0.0)
    # A zero horizon asks for a later price: the least later time.
    due = F.unix_micros(F.col("timestamp") + F.expr(f"interval {horizon}")) + (1 if zero else 0)
    ties = {f"_tie{i}": prices.schema[c].dataType for i, c in enumerate(tie)}
    blank = {name: F.lit("" if kind.simpleString() == "string" else 0).cast(kind) for name, kind in ties.items()}
    asked = predictions.select(
        "symbol", F.col("timestamp").alias("event_ts"), F.lit(1).cast("long").alias("_side"), F.col("id").cast("long").alias("_id"), due.alias("_due"),
        F.col("current_price").alias("_price"), F.col("predicted_price").alias("_predicted"), F.col("predicted_return").alias("_return"),
        *(c.alias(name) for name, c in blank.items()),
    )
    seen = prices.select(
        "symbol", "event_ts", F.lit(0).cast("long").alias("_side"), F.lit(0).cast("long").alias("_id"), F.lit(0).cast("long").alias("_due"),
        F.col("price").alias("_price"), nothing.alias("_predicted"), nothing.alias("_return"), *(F.col(c).alias(n) for c, n in zip(tie, ties)),
    )
    line = asked.unionByName(seen).withWatermark("event_ts", late_after).withColumn("_at", F.unix_micros("event_ts"))
    columns = [*_LINE, *ties]
    held = [StructField(f"{HELD}{c}", ArrayType(line.schema[c].dataType), False) for c in columns]
    waits = [StructField(f"_waits{c}", ArrayType(LongType() if c in ("_id", "_at", "_due") else DoubleType()), False) for c in _WAITS]
    give_up_us = None
    if give_up is not None:
        give_up_us = int(pd.Timedelta(give_up).total_seconds() * 1_000_000)
    step = _meet(columns, fifo, give_up_us)
    rows = line.select("symbol", "event_ts", *columns)
    return rows.groupBy("symbol").applyInPandasWithState(step, REALIZED, StructType([*held, *waits]), "append", GroupStateTimeout.EventTimeTimeout)


def stream_realize_fifo(
    predictions: DataFrame, prices: DataFrame, late_after: str, tie: Sequence[str] = (), give_up: str | None = None
) -> DataFrame:
    """Each price of a stream realizes the oldest prediction of its symbol that waits; one row for each pair.

    Rows of both streams wait until the watermark of ``late_after`` has passed them and are then taken in order, prices before
    predictions of the same time. The state of a symbol is the rows of the delay and the predictions that wait;
    ``give_up`` (such as '2 days') drops those that have waited longer.
    """
    return _joined(predictions, prices, late_after, tie, "0 seconds", True, give_up)


def stream_realize_asof(
    predictions: DataFrame, prices: DataFrame, late_after: str, horizon: str = "0 seconds", tie: Sequence[str] = (), give_up: str | None = None
) -> DataFrame:
    """Each prediction of a stream is realized by the first price at least ``horizon`` later, or strictly later if that is zero."""
    return _joined(predictions, prices, late_after, tie, horizon, False, give_up)
