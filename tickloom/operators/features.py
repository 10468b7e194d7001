"""Per-tick features: change, return, moving averages, volume-weighted price, range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import ratio
from tickloom.operators.ingest import validate_events
from tickloom.operators.ordered import SLICE, Ordering, cut, finish, framed
from tickloom.schemas import TICK_DERIVED, TICK_FEATURES

# Fixed values.
SHORT, LONG = 5, 20  # ticks in the moving averages, the current one included


def tick_order(df: DataFrame, tie: Sequence[str] | None = None) -> list[str]:
    """Event time first; ``tie`` (by default the idempotency key) settles equal times."""
    if tie is None:
        tie = ["idempotency_key"] if "idempotency_key" in df.columns else []
    return ["event_ts", *tie]


def add_tick_columns(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Append the derived columns for rows ordered by ``w``. One sort serves all of them."""
    short, long = w.rowsBetween(1 - SHORT, 0), w.rowsBetween(1 - LONG, 0)
    price, volume = F.col("price"), F.col("volume")
    windowed = df.withColumns(
        {
            "_price_before": F.lag(price).over(w),
            "_volume_before": F.lag(volume).over(w),
            "ma5": F.avg(price).over(short),
            "ma20": F.avg(price).over(long),
            "_turnover": F.sum(price * volume).over(long),
            "_traded": F.sum(volume).over(long),
            "_high": F.max(price).over(long),
            "_low": F.min(price).over(long),
        }
    )
    before = F.col("_price_before")
    return (
        windowed.withColumns(
            {
                "price_change": price - before,
                "price_return": ratio(price - before, before),
                "volume_change": volume - F.col("_volume_before"),
                "vwap": F.try_divide("_turnover", "_traded"),
                "price_range": F.col("_high") - F.col("_low"),
            }
        )
        .withColumns({f"{c}_ratio": F.col(c) / price for c in ("ma5", "ma20", "vwap", "price_range")})
        .drop("_price_before", "_volume_before", "_turnover", "_traded", "_high", "_low")
    )


def add_return_averages(df: DataFrame, w: WindowSpec, averages: Mapping[str, int]) -> DataFrame:
    """Append means of the last returns: column name to number of ticks."""
    return df.withColumns({name: F.avg("price_return").over(w.rowsBetween(1 - n, 0)) for name, n in averages.items()})


def feature_slices(
    df: DataFrame, tie: Sequence[str] | None = None, keep: Sequence[str] = (), averages: Mapping[str, int] | None = None
) -> Ordering:
    """``tick_features`` in slices by symbol and tick order, for more ordered work on them."""
    averages = averages or {}
    valid = validate_events(df)
    order = tick_order(valid, tie)
    valid = valid.select(*dict.fromkeys(["symbol", *order, "price", "volume", *keep]))

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return add_return_averages(add_tick_columns(rows, w), w, averages)

    # A mean of n returns looks at the price before the first of them.
    rows = framed(cut(valid, ["symbol"], order), max(LONG - 1, *averages.values(), 0), 0, add)
    shown = dict.fromkeys([*TICK_FEATURES, *averages, *keep, *order])
    return rows.map(lambda made: made.select(*shown, SLICE))


def tick_features(
    df: DataFrame, tie: Sequence[str] | None = None, keep: Sequence[str] = (), averages: Mapping[str, int] | None = None
) -> DataFrame:
    """Validated events to the 15 feature columns (plus ``averages`` of returns and ``keep``), one row per tick."""
    rows = finish(feature_slices(df, tie, keep, averages))
    return rows.select(*dict.fromkeys([*TICK_FEATURES, *(averages or {}), *keep]))


def compute_features(df: DataFrame, mode: str = "streaming", **options) -> DataFrame:
    """The same columns from a table (``batch``) or a stream (``streaming``)."""
    if mode == "batch":
        return tick_features(df, **options)
    if mode == "streaming":
        from tickloom.streaming.features import stream_tick_features

        return stream_tick_features(df, **options)
    raise ValueError(f"mode must be 'batch' or 'streaming', not {mode!r}")


__all__ = [
    "TICK_DERIVED", "add_return_averages", "add_tick_columns", "compute_features", "feature_slices", "tick_features", "tick_order",
]
