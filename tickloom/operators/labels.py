"""Training rows: labels, leak-free splits in time, simple baselines, error metrics, the promotion gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.columns import improvement_passes
from tickloom.operators.features import LONG, add_return_averages, add_tick_columns, tick_order
from tickloom.operators.ingest import validate_events, validate_training_data
from tickloom.operators.ordered import SLICE, Ordering, bounded_window, cut, finish, framed, values_at_ranks
from tickloom.schemas import TICK_FEATURES
from tickloom.sources.scratch import settled

TARGET = "target_return"


def prepared_slices(
    raw: DataFrame, tie: Sequence[str] | None = None, keep: Sequence[str] = (), averages: Mapping[str, int] | None = None
) -> Ordering:
    """``prepare_training`` in slices by symbol and tick order, for more ordered work on them."""
    averages = averages or {}
    valid = validate_events(validate_training_data(raw, order=list(tie) if tie else None))
    order = tick_order(valid, tie)
    valid = valid.select(*dict.fromkeys(["symbol", *order, "price", "volume", *keep]))

    def add(df: DataFrame, w: WindowSpec) -> DataFrame:
        labelled = df.withColumn("target_price", F.lead("price").over(w))
        return add_return_averages(add_tick_columns(labelled, w), w, averages)

    rows = framed(cut(valid, ["symbol"], order), max(LONG - 1, *averages.values(), 0), 1, add)
    shown = dict.fromkeys([*TICK_FEATURES, "target_price", TARGET, *averages, *keep, *order])
    target = (F.col("target_price") - F.col("price")) / F.col("price")
    return rows.map(lambda made: made.where(F.col("target_price").isNotNull()).withColumn(TARGET, target).select(*shown, SLICE))


def prepare_training(
    raw: DataFrame, tie: Sequence[str] | None = None, keep: Sequence[str] = (), averages: Mapping[str, int] | None = None
) -> DataFrame:
    """Raw events to features plus the next tick's price and return. The newest tick has no label and is dropped.

    ``averages`` adds moving-average predictions (name to number of returns) in the same pass.
    """
    rows = finish(prepared_slices(raw, tie, keep, averages))
    return rows.select(*dict.fromkeys([*TICK_FEATURES, "target_price", TARGET, *(averages or {}), *keep]))


# --- splits in time -------------------------------------------------------------------------------


def last_rank_within(n: int, share: float, inclusive: bool = True) -> int:
    """Largest 0-based position k with k / (n - 1) <= share (or < share); -1 when there is none.

    This is where ``percent_rank`` crosses the share, in the same floating-point arithmetic.
    """

    def within(k: int) -> bool:
        rank = k / (n - 1) if n > 1 else 0.0
        return rank <= share if inclusive else rank < share

    k = min(max(int(share * (n - 1)), 0), n - 1)
    while k + 1 < n and within(k + 1):
        k += 1
    while k >= 0 and not within(k):
        k -= 1
    return k


def _cut_times(
    df: DataFrame, column: str, bounds: list[tuple[float, bool]], stored: bool = False
) -> list[int | None]:
    """For each (share, inclusive): the last time whose percent rank is within the share, in microseconds."""
    ranks: list[int] = []

    def wanted(n: int) -> list[int]:
        ranks.extend(last_rank_within(n, share, inclusive) for share, inclusive in bounds)
        return ranks

    _, values = values_at_ranks(df, column, wanted, stored)
    return [v if r >= 0 else None for r, v in zip(ranks, values)] if values else [None] * len(bounds)


def _until(column: str, micros: int | None) -> Column:
    return F.lit(False) if micros is None else F.col(column) <= F.timestamp_micros(F.lit(micros))


@dataclass(frozen=True)
class TimeSplit:
    """Train, validation and test, cut at two points in time. Rows of equal time stay together."""

    column: str
    train_until: int | None
    validate_until: int | None

    def label(self) -> Column:
        return (
            F.when(_until(self.column, self.train_until), "train")
            .when(_until(self.column, self.validate_until), "val")
            .otherwise("test")
        )

    def parts(self, df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        train, validate = _until(self.column, self.train_until), _until(self.column, self.validate_until)
        return df.where(train), df.where(~train & validate), df.where(~validate)


def split_times(
    df: DataFrame, train: float = 0.7, validate: float = 0.15, column: str = "event_ts", stored: bool = False
) -> TimeSplit:
    """Find the two cut times of the whole table; nothing is sorted and no task sees all rows."""
    return TimeSplit(column, *_cut_times(df, column, [(train, True), (train + validate, True)], stored))


def chronological_split(
    df: DataFrame, train: float = 0.7, validate: float = 0.15, column: str = "event_ts"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    stored = settled(df)  # the cut times and the parts read it
    return split_times(stored, train, validate, column, True).parts(stored)


def with_split(df: DataFrame, train: float = 0.7, validate: float = 0.15, column: str = "event_ts") -> DataFrame:
    stored = settled(df)
    return stored.withColumn("split", split_times(stored, train, validate, column, True).label())


def walk_forward_chunks(
    df: DataFrame, n: int = 5, compat: bool = False, column: str = "event_ts", times: DataFrame | None = None
) -> DataFrame:
    """Number equal chunks of the timeline in a column ``chunk``.

    With ``compat`` the last chunk ends before rank 1.0, so a newest row that is alone at its time drops out.
    ``times`` may give the stored time column of ``df``.
    """
    bounds = [((i + 1) / n, False) for i in range(n)]
    *inner, newest = _cut_times(df if times is None else times, column, bounds, times is not None)
    chunk = F.lit(0)
    for bound in inner:
        chunk = chunk + F.when(_until(column, bound), 0).otherwise(1)
    return (df.where(_until(column, newest)) if compat else df).withColumn("chunk", chunk)


# --- baselines and metrics ------------------------------------------------------------------------


def moving_average_prediction(
    df: DataFrame, window: int = 5, tie: Sequence[str] | None = None, name: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Predict the next return as the mean of the last ``window`` returns of the symbol."""

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumn(name, F.avg("price_return").over(w.rowsBetween(1 - window, 0)))

    return bounded_window(df, [*by, "symbol"], tick_order(df, tie), window - 1, 0, add)


def regression_metrics(df: DataFrame, label: str, prediction: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """rmse, mse, mae, r2 and explained variance in one pass, over rows that have both values."""
    pairs = df.select(*by, F.col(label).alias("_y"), (F.col(prediction) if isinstance(prediction, str) else prediction).alias("_p"))
    pairs = pairs.where(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    error = F.col("_y") - F.col("_p")
    sums = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop("_y").alias("_spread"),
        F.avg("_y").alias("_mean"),
        F.avg("_p").alias("_mean_p"),
        F.var_pop("_p").alias("_spread_p"),
    )
    gap = F.col("_mean_p") - F.col("_mean")
    return sums.select(
        *by,
        "n",
        F.sqrt("mse").alias("rmse"),
        "mse",
        "mae",
        (1 - F.try_divide("mse", "_spread")).alias("r2"),
        (F.col("_spread_p") + gap * gap).alias("var"),
    )


def persistence_baseline(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors of predicting that the price stays where it is."""
    return regression_metrics(df, "target_price", "price", by)


def zero_return_baseline(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors of predicting no change."""
    return regression_metrics(df, TARGET, F.lit(0.0), by)


def moving_average_baseline(
    df: DataFrame, window: int = 5, tie: Sequence[str] | None = None, by: Sequence[str] = (), within: Sequence[str] = ()
) -> DataFrame:
    """Errors of the moving-average prediction; ``within`` restarts the average per such group (e.g. a chunk)."""
    predicted = moving_average_prediction(df, window, tie, "_ma", within)
    return regression_metrics(predicted, TARGET, "_ma", by)


def promotion_gate(metrics: DataFrame, min_improvement_pct: float = 0.0, min_baseline_pct: float = 0.0) -> DataFrame:
    """Decide per row of (test_rmse, zero_return_rmse, production_rmse) whether the model may go live.

    It must beat the no-change baseline and, if there is one, the production model.
    """
    beats = F.col("test_rmse") < F.col("zero_return_rmse") * (1 - min_baseline_pct / 100.0)
    passes = improvement_passes(F.col("test_rmse"), F.col("production_rmse"), min_improvement_pct)
    return metrics.withColumns(
        {"beats_baseline": beats, "beats_production": passes, "promotable": F.coalesce(beats & passes, F.lit(False))}
    )
