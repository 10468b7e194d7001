"""Back-test of predicted returns: go long when the prediction is positive, short otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import direction, same_sign
from tickloom.operators.ordered import Ordering, carried, cut, finish

# Fixed value: trading days of a year.
TRADING_DAYS = 252
SUMMARY = [
    "total_return", "sharpe_ratio", "max_drawdown", "win_rate",
    "profit_factor", "directional_accuracy", "buy_and_hold_return",
]


def with_signal(df: DataFrame) -> DataFrame:
    signal = direction(F.col("predicted_return"))
    return df.withColumns({"signal": signal, "strategy_return": signal * F.col("realized_return")})


def equity_curve(
    df: DataFrame | Ordering, keys: Sequence[str] = ("symbol",), order: Sequence[str] = ("event_ts",), capital: float = 10_000.0
) -> DataFrame:
    """Equity after each trade, its running peak and the drawdown from it.

    ``keys=()`` trades all symbols as one account in ``order``. ``df`` may be rows in slices of these keys and this order.
    """
    rows = df.map(with_signal) if isinstance(df, Ordering) else cut(with_signal(df), keys, order)
    rows = carried(rows, {"_growth": ("product", 1 + F.col("strategy_return"))})
    rows = rows.map(lambda grown: grown.withColumn("equity", capital * F.col("_growth")).drop("_growth"))
    rows = carried(rows, {"peak": ("max", F.col("equity"))})
    return finish(rows).withColumn("drawdown", (F.col("equity") - F.col("peak")) / F.col("peak"))


def backtest_summary(
    df: DataFrame | Ordering,
    keys: Sequence[str] = ("symbol",),
    order: Sequence[str] = ("event_ts",),
    capital: float = 10_000.0,
    periods_per_year: int = TRADING_DAYS,
) -> DataFrame:
    """Return, Sharpe ratio, drawdown, win rate, profit factor, accuracy and buy-and-hold, per key."""
    made = F.col("strategy_return")
    win, loss = F.when(made > 0, made), F.when(made < 0, made)
    hit = same_sign(F.col("predicted_return"), F.col("realized_return"))
    spread = F.coalesce(F.stddev_samp(made), F.lit(0.0))
    summary = (
        equity_curve(df, keys, order, capital)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_trades"),
            (F.product(1 + made) - 1).alias("total_return"),
            F.when(spread > 0, F.avg(made) / spread * periods_per_year**0.5).otherwise(0.0).alias("sharpe_ratio"),
            F.min("drawdown").alias("max_drawdown"),
            F.avg(F.when(made > 0, 1.0).otherwise(0.0)).alias("win_rate"),
            F.when(F.sum(loss) < 0, F.coalesce(F.sum(win), F.lit(0.0)) / F.abs(F.sum(loss)))
            .when(F.count(F.lit(1)) > 0, F.lit(float("inf")))
            .alias("profit_factor"),
            F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("directional_accuracy"),
            (F.product(1 + F.col("realized_return")) - 1).alias("buy_and_hold_return"),
        )
    )
    return summary.select(*keys, "n_trades", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in SUMMARY])
