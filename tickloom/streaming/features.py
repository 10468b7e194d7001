"""The same features on streams: per tick with state, and per time window with watermarks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, StructField, StructType

from tickloom.operators.features import LONG, SHORT, tick_order
from tickloom.operators.ingest import validate_events
from tickloom.operators.time_windows import BASE_COLUMNS, _DERIVED, HORIZONS, derive_window_columns, seconds_of, tumbling_bars
from tickloom.schemas import FEATURE_ROW, STREAM_STATE, TICK_FEATURES


def _tick_frame(ticks: pd.DataFrame, prices: list[float], volumes: list[float]) -> pd.DataFrame:
    """Features of new ticks of one symbol, given the ticks before them. Frames reach into that history."""
    known = len(prices)
    price = pd.Series(np.concatenate([prices, ticks["price"].to_numpy(float)]))
    volume = pd.Series(np.concatenate([volumes, ticks["volume"].to_numpy(float)]))
    short, long = price.rolling(SHORT, min_periods=1), price.rolling(LONG, min_periods=1)
    # Each frame is summed anew: a rolling sum would carry rounding errors along the stream.
    traded = _frame_sums(volume, LONG)
    out = pd.DataFrame({"price": price, "volume": volume})
    out["price_change"] = price.diff()
    out["price_return"] = out["price_change"] / price.shift()
    out["volume_change"] = volume.diff()
    out["ma5"] = _frame_sums(price, SHORT) / short.count()
    out["ma20"] = _frame_sums(price, LONG) / long.count()
    out["vwap"] = (_frame_sums(price * volume, LONG) / traded).where(traded > 0)
    out["price_range"] = long.max() - long.min()
    for column in ("ma5", "ma20", "vwap", "price_range"):
        out[f"{column}_ratio"] = out[column] / price
    out = out.iloc[known:].reset_index(drop=True)
    out.insert(0, "symbol", ticks["symbol"].to_numpy())
    out.insert(1, "event_ts", ticks["event_ts"].to_numpy())
    return out[TICK_FEATURES]


def _frame_sums(values: pd.Series, size: int) -> pd.Series:
    """Sum of the last ``size`` values at each place, fewer at the start."""
    padded = np.concatenate([np.zeros(size - 1), values.to_numpy(float)])
    return pd.Series(np.lib.stride_tricks.sliding_window_view(padded, size).sum(axis=1))


def _update(order: Sequence[str], ttl_ms: int | None, by_event_time: bool):
    """State function: append the batch's ticks of a symbol to its last ticks and emit their features."""

    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        prices, volumes = (list(part) for part in state.get) if state.exists else ([], [])
        ticks = pd.concat(list(batches)).sort_values(list(order), kind="stable", ignore_index=True)
        if ticks.empty:
            return
        yield _tick_frame(ticks, prices, volumes)
        state.update(
            (
                (prices + ticks["price"].tolist())[1 - LONG :],
                (volumes + ticks["volume"].tolist())[1 - LONG :],
            )
        )
        if ttl_ms is not None and by_event_time:
            latest = int(ticks["event_ts"].max().timestamp() * 1000)
            state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + ttl_ms)
        elif ttl_ms is not None:
            state.setTimeoutDuration(ttl_ms)

    return step


def stream_tick_features(
    df: DataFrame, tie: Sequence[str] | None = None, late_after: str | None = None, ttl_ms: int | None = None
) -> DataFrame:
    """Tick features of a stream; equal to the batch ones when ticks arrive in order across triggers.

    A trigger's ticks of a symbol are sorted together, so their order inside a trigger does not matter;
    the source's per-trigger limit (maxOffsetsPerTrigger, maxFilesPerTrigger) bounds that group. A tick
    that arrives in a later trigger than its successor is appended where it arrives, unless ``late_after``
    sets a watermark that drops it. The state is the last 19 ticks per symbol; ``ttl_ms`` forgets symbols
    that stay silent that long.
    """
    valid = validate_events(df)
    if late_after is not None:
        valid = valid.withWatermark("event_ts", late_after)
    order = tick_order(valid, tie)
    valid = valid.select(*dict.fromkeys(["symbol", *order, "price", "volume"]))
    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    if late_after is not None:  # only with this timeout does Spark drop what is older than the watermark
        timeout = GroupStateTimeout.EventTimeTimeout
    return valid.groupBy("symbol").applyInPandasWithState(_update(order, ttl_ms, late_after is not None), FEATURE_ROW, STREAM_STATE, "append", timeout)


HELD = "_held_"  # prefix of the state's columns of rows that wait


def in_order(
    columns: Sequence[str], order: Sequence[str], waiting: Sequence[list], batches: Iterable[pd.DataFrame], state: GroupState
) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Rows that the watermark has passed, in order, and those that still wait; ``_at`` has times in microseconds.

    Spark drops what comes later with a time up to the watermark, so that nothing can come before the first ones any more.
    """
    held = pd.DataFrame(dict(zip(columns, waiting)))
    new = [part[list(columns)] for part in batches if len(part)]
    if new:
        held = pd.concat([held, *new] if len(held) else new, ignore_index=True)
    held = held.sort_values(list(order), kind="stable", ignore_index=True)
    ready = int((held["_at"] <= state.getCurrentWatermarkMs() * 1000).sum())
    return held.iloc[:ready], held.iloc[ready:]


def _update_in_order(columns: Sequence[str], ttl_ms: int | None):
    """State function: hold ticks back until the watermark has passed them, then emit their features in order.

    ``columns`` are the time in microseconds, the tie-breaks, price and volume. The state is the last ticks that were emitted,
    and one list for each column of those that wait.
    """

    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prices, volumes, *waiting = (list(part) for part in state.get) if state.exists else ([], [], *([] for _ in columns))
        if state.hasTimedOut and not waiting[0]:
            state.remove()
            return
        ready, held = in_order(columns, columns[:-2], waiting, batches, state)
        if len(ready):
            ticks = ready.assign(symbol=key[0], event_ts=pd.to_datetime(ready["_at"], unit="us"))
            yield _tick_frame(ticks, prices, volumes)
            prices, volumes = (prices + ready["price"].tolist())[1 - LONG :], (volumes + ready["volume"].tolist())[1 - LONG :]
        state.update((prices, volumes, *(held[c].tolist() for c in columns)))
        if len(held):
            state.setTimeoutTimestamp(-(-int(held["_at"].iloc[0]) // 1000))
        elif ttl_ms is not None:
            state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + ttl_ms)

    return step


def stream_ordered_tick_features(
    df: DataFrame, late_after: str, tie: Sequence[str] | None = None, ttl_ms: int | None = None
) -> DataFrame:
    """Tick features of a stream that equal the batch ones for any order of arrival within ``late_after``.

    A tick waits until the watermark has passed its time, so that all ticks before it are there; later ones are dropped. The
    state of a symbol is its last 19 ticks and those of the delay; ``ttl_ms`` of event time forgets symbols without any.
    """
    valid = validate_events(df).withWatermark("event_ts", late_after)
    order = tick_order(valid, tie)
    columns = ["_at", *order[1:], "price", "volume"]
    valid = valid.withColumn("_at", F.unix_micros("event_ts")).select("symbol", "event_ts", *columns)
    held = [StructField(f"{HELD}{c}", ArrayType(valid.schema[c].dataType), False) for c in columns]
    state = StructType([*STREAM_STATE.fields, *held])
    step = _update_in_order(columns, ttl_ms)
    return valid.groupBy("symbol").applyInPandasWithState(step, FEATURE_ROW, state, "append", GroupStateTimeout.EventTimeTimeout)


def stream_time_window_features(
    df: DataFrame, duration: str = "1 minute", watermark: str = "2 minutes", tie: Sequence[str] | None = None
) -> DataFrame:
    """Bars with 5 and 20 minute means from a stream, each bar once its windows are complete.

    Two aggregates in a row: ticks into bars, and finished bars, by the time of their end, into the sliding windows that cover
    them. A window hands out the bar that ends it, beside the means of all its bars, so that only bars are copied into
    windows and nothing is joined.
    """
    step, lengths = seconds_of(df, duration), {name: seconds_of(df, horizon) for name, horizon in HORIZONS.items()}
    if any(length % step for length in lengths.values()):
        raise ValueError(f"a window of {duration} does not divide the horizons {sorted(HORIZONS.values())}")
    valid = validate_events(df).withWatermark("event_ts", watermark)
    bars = tumbling_bars(valid, duration, tick_order(valid, tie)).withColumn("_at", F.window_time("window")).drop("window")
    covered = bars.withColumn("_w", F.window("_at", f"{max(lengths.values())} seconds", f"{step} seconds"))
    end, at = F.col("_w.end"), F.col("_at")
    sums = {}
    for name, length in lengths.items():
        inside = at >= end - F.make_dt_interval(secs=F.lit(length))
        sums[name] = F.sum(F.when(inside, F.col("_price_sum"))) / F.sum(F.when(inside, F.col("_ticks")))
    last = at >= end - F.make_dt_interval(secs=F.lit(step))
    own = [F.max(F.when(last, F.col(c))).alias(c) for c in BASE_COLUMNS]
    made = covered.groupBy("_w", "symbol").agg(F.count_if(last).alias("_own"), *own, *(c.alias(n) for n, c in sums.items()))
    window = F.struct((end - F.make_dt_interval(secs=F.lit(step))).alias("start"), end.alias("end"))
    bars = made.where(F.col("_own") > 0).withColumn("window", window)
    return derive_window_columns(bars).select("window", "symbol", *BASE_COLUMNS, *HORIZONS, *_DERIVED)
