"""Features of fixed time windows: open/close/high/low/volume per window and sliding means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import ratio
from tickloom.operators.features import tick_order
from tickloom.operators.ingest import validate_events

# Fixed values.
HORIZONS = {"ma5": "5 minutes", "ma20": "20 minutes"}
BASE_COLUMNS = [
    "first_price", "last_price", "avg_price", "max_price", "min_price",
    "first_volume", "last_volume", "volume_sum", "vwap",
]


def seconds_of(df: DataFrame, duration: str) -> int:
    """Length of a duration text such as '5 minutes', as Spark reads it."""
    probe = F.window(F.timestamp_seconds(F.lit(0)), duration)
    row = df.sparkSession.range(1).select((F.unix_seconds(probe.end) - F.unix_seconds(probe.start)).alias("s")).first()
    return row["s"]


def tumbling_bars(df: DataFrame, duration: str, order: Sequence[str], window: str = "window") -> DataFrame:
    """One row per (window, symbol). First and last follow the full order, so ties are settled."""
    place = [F.col(c) for c in order]
    quote = ["price", "volume"]
    return (
        df.groupBy(F.window("event_ts", duration).alias(window), "symbol")
        .agg(
            F.min(F.struct(*place, *quote)).alias("_first"),
            F.max(F.struct(*place, *quote)).alias("_last"),
            F.avg("price").alias("avg_price"),
            F.max("price").alias("max_price"),
            F.min("price").alias("min_price"),
            F.sum("volume").alias("volume_sum"),
            F.sum(F.col("price") * F.col("volume")).alias("_turnover"),
            F.sum("price").alias("_price_sum"),
            F.count("price").alias("_ticks"),
        )
        .withColumns(
            {
                "first_price": F.col("_first.price"),
                "last_price": F.col("_last.price"),
                "first_volume": F.col("_first.volume"),
                "last_volume": F.col("_last.volume"),
                "vwap": F.try_divide("_turnover", "volume_sum"),
            }
        )
        .drop("_first", "_last", "_turnover")
    )


def derive_window_columns(bars: DataFrame) -> DataFrame:
    """Change, return, range and the ratios to the window's last price."""
    first, last = F.col("first_price"), F.col("last_price")
    return bars.withColumns(
        {
            "price_change": last - first,
            "price_return": ratio(last - first, first),
            "volume_change": F.col("last_volume") - F.col("first_volume"),
            "price_range": F.col("max_price") - F.col("min_price"),
        }
    ).withColumns({f"{c}_ratio": ratio(F.col(c), last) for c in ("ma5", "ma20", "vwap", "price_range")})


def time_window_features(df: DataFrame, duration: str = "1 minute", tie: Sequence[str] | None = None) -> DataFrame:
    """Bars plus 5 and 20 minute means of all ticks up to the end of each bar.

    Ticks are aggregated to bars once; the sliding means are range frames over the bars. A bar table has
    at most one row per symbol and window, so these frames grow with time covered, not with ticks.
    """
    valid = validate_events(df)
    step = seconds_of(df, duration)
    bars = tumbling_bars(valid, duration, tick_order(valid, tie))
    bars = bars.withColumn("_start", F.unix_seconds(F.col("window.start")))
    by_time = Window.partitionBy("symbol").orderBy("_start")
    means = {}
    for name, horizon in HORIZONS.items():
        length = seconds_of(df, horizon)
        if length % step:
            raise ValueError(f"a window of {duration} does not divide {horizon}")
        frame = by_time.rangeBetween(step - length, 0)
        means[name] = F.sum("_price_sum").over(frame) / F.sum("_ticks").over(frame)
    return derive_window_columns(bars.withColumns(means)).select("window", "symbol", *BASE_COLUMNS, *HORIZONS, *_DERIVED)


_DERIVED = [
    "price_change", "price_return", "volume_change", "price_range",
    "ma5_ratio", "ma20_ratio", "vwap_ratio", "price_range_ratio",
]


def ohlcv_bars(df: DataFrame, duration: str = "1 minute", tie: Sequence[str] | None = None) -> DataFrame:
    valid = validate_events(df)
    bars = tumbling_bars(valid, duration, tick_order(valid, tie))
    return bars.select("window", "symbol", *BASE_COLUMNS)


def sliding_mean(df: DataFrame, horizon: str, slide: str = "1 minute", name: str = "mean_price") -> DataFrame:
    """Mean price per sliding window and symbol.

    Ticks are summed per slide first; only those few partial sums are copied into the windows that
    cover them, instead of every tick.
    """
    length, step = seconds_of(df, horizon), seconds_of(df, slide)
    if length % step:
        raise ValueError(f"a slide of {slide} does not divide {horizon}")
    parts = (
        validate_events(df)
        .groupBy(F.window("event_ts", slide).start.alias("_at"), "symbol")
        .agg(F.sum("price").alias("_sum"), F.count("price").alias("_n"))
    )
    start = F.unix_seconds("_at")
    covering = F.sequence(start - (length - step), start, F.lit(step).cast("long"))
    return (
        parts.withColumn("_start", F.explode(covering))
        .groupBy("_start", "symbol")
        .agg((F.sum("_sum") / F.sum("_n")).alias(name))
        .select(
            F.struct(
                F.timestamp_seconds("_start").alias("start"), F.timestamp_seconds(F.col("_start") + length).alias("end")
            ).alias("window"),
            "symbol",
            name,
        )
    )
