"""Roll-ups of the request log and accuracy gauges: rates, latency quantiles, alerts, health bands.

Everything windowed here runs on counts per (symbol, time step), whose size follows the time covered and
not the number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.schemas import REALIZED_AT

# Upper bounds of the latency histogram in seconds; fixed values.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]

# Alert limits and times in seconds; fixed values.
LATENCY_LIMIT = 1.0
RMSE_LIMIT = 0.02
ERROR_RATIO_LIMIT = 0.05
HOLD_SECONDS = 300
RANGE_SECONDS = 300
STEP_SECONDS = 30


def _start(ts: str, seconds: int) -> Column:
    epoch = F.unix_seconds(ts)
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds))).alias("window_start")


def request_rate(log: DataFrame, seconds: int = 60, by: Sequence[str] = ("symbol", "status")) -> DataFrame:
    """Requests per second in each window."""
    return log.groupBy(_start("ts", seconds), *by).agg((F.count(F.lit(1)) / seconds).alias("rate"))


def error_rate_by_type(log: DataFrame, seconds: int = 60) -> DataFrame:
    return request_rate(log.where(F.col("error_type").isNotNull()), seconds, ("symbol", "error_type"))


def _bucket_counts() -> list[Column]:
    """Cumulative counts per bound, and the total."""
    below = [F.count_if(F.col("latency_s") <= b).alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)]
    return [*below, F.count("latency_s").alias("le_inf")]


_COUNTS = [*[f"le_{i}" for i in range(len(LATENCY_BOUNDS))], "le_inf"]


def latency_counts(log: DataFrame, seconds: int = 60) -> DataFrame:
    return log.groupBy(_start("ts", seconds), "symbol").agg(*_bucket_counts())


def latency_histogram(log: DataFrame, seconds: int = 60) -> DataFrame:
    """Long form: one row per window, symbol and upper bound with the cumulative count."""
    bounds = [*[str(b) for b in LATENCY_BOUNDS], "+Inf"]
    pairs = F.array(*[F.struct(F.lit(b).alias("le"), F.col(c).alias("requests")) for b, c in zip(bounds, _COUNTS)])
    return latency_counts(log, seconds).select("window_start", "symbol", F.inline(pairs))


def histogram_quantile(q: float) -> Column:
    """Quantile from cumulative counts, linear inside a bucket; beyond the last bound it is that bound."""
    rank = F.lit(q) * F.col("le_inf")
    value = F.when(F.col("le_inf") == 0, None)
    below: Column = F.lit(0)
    low = 0.0
    for i, high in enumerate(LATENCY_BOUNDS):
        count = F.col(f"le_{i}")
        value = value.when(count >= rank, F.lit(low) + (high - low) * F.try_divide(rank - below, count - below))
        below, low = count, high
    return value.otherwise(LATENCY_BOUNDS[-1])


def latency_quantiles(log: DataFrame, seconds: int = 60) -> DataFrame:
    """p50, p95 and p99 per window and symbol."""
    return latency_counts(log, seconds).select(
        "window_start", "symbol", *[histogram_quantile(q).alias(f"p{round(q * 100)}") for q in (0.5, 0.95, 0.99)]
    )


# --- alerts ---------------------------------------------------------------------------------------


def over_range(parts: DataFrame, sums: Sequence[str], range_s: int = RANGE_SECONDS, step_s: int = STEP_SECONDS) -> DataFrame:
    """Sums over the last ``range_s`` at every step that has data in it.

    ``parts`` holds sums per (window_start, symbol) of ``step_s``; each is copied to the steps it counts for.
    """
    end = F.unix_seconds("window_start") + step_s
    return (
        parts.withColumn("_at", F.explode(F.sequence(end, end + (range_s - step_s), F.lit(step_s).cast("long"))))
        .groupBy(F.timestamp_seconds("_at").alias("at"), "symbol")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def held(evaluations: DataFrame, breach: Column, hold_s: int = HOLD_SECONDS, step_s: int = STEP_SECONDS) -> DataFrame:
    """Episodes in which the condition stayed true at consecutive steps for at least ``hold_s``.

    A step without data ends an episode. One row per episode: pending since, firing since, last true step.
    """
    step_number = F.col("_at") / step_s
    breaches = evaluations.where(breach).withColumn("_at", F.unix_seconds("at"))
    place = F.row_number().over(Window.partitionBy("symbol").orderBy("_at"))
    return (
        breaches.withColumn("_episode", step_number.cast("long") - place)
        .groupBy("symbol", "_episode")
        .agg(F.min("_at").alias("_from"), F.max("_at").alias("_to"))
        .where(F.col("_to") - F.col("_from") >= hold_s)
        .select(
            "symbol",
            F.timestamp_seconds("_from").alias("pending_since"),
            F.timestamp_seconds(F.col("_from") + hold_s).alias("firing_since"),
            F.timestamp_seconds("_to").alias("last_true"),
        )
    )


def latency_alerts(
    log: DataFrame, limit: float = LATENCY_LIMIT, q: float = 0.99, range_s: int = RANGE_SECONDS,
    hold_s: int = HOLD_SECONDS, step_s: int = STEP_SECONDS,
) -> DataFrame:
    """The latency quantile over the range is above the limit for the hold time."""
    evaluations = over_range(latency_counts(log, step_s), _COUNTS, range_s, step_s)
    return held(evaluations, histogram_quantile(q) > limit, hold_s, step_s)


def error_ratio_alerts(
    log: DataFrame, limit: float = ERROR_RATIO_LIMIT, range_s: int = RANGE_SECONDS,
    hold_s: int = HOLD_SECONDS, step_s: int = STEP_SECONDS,
) -> DataFrame:
    """The share of failed requests of a symbol over the range is above the limit for the hold time."""
    parts = log.groupBy(_start("ts", step_s), "symbol").agg(
        F.count_if(F.col("status") == "error").alias("errors"), F.count(F.lit(1)).alias("requests")
    )
    evaluations = over_range(parts, ["errors", "requests"], range_s, step_s)
    return held(evaluations, F.col("errors") / F.col("requests") > limit, hold_s, step_s)


def rmse_gauge(realized: DataFrame, step_s: int = STEP_SECONDS, ts: str | None = None) -> DataFrame:
    """Return RMSE over everything realized so far, at each step with news. A gauge holds between steps.

    An error is known from the time ``realized_at``, or, in tables without it, that of the prediction.
    """
    ts = ts or (REALIZED_AT if REALIZED_AT in realized.columns else "timestamp")
    error = F.col("realized_return_error")
    known = realized.where(error.isNotNull())
    end = F.unix_seconds(ts)
    end = end - F.pmod(end, F.lit(step_s)) + step_s
    parts = known.groupBy(end.alias("_at"), "symbol").agg(F.sum(error * error).alias("_sq"), F.count(error).alias("_n"))
    so_far = Window.partitionBy("symbol").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return parts.select("symbol", "_at", F.sqrt(F.sum("_sq").over(so_far) / F.sum("_n").over(so_far)).alias("rmse_return"))


def rmse_alerts(
    realized: DataFrame, limit: float = RMSE_LIMIT, hold_s: int = HOLD_SECONDS, step_s: int = STEP_SECONDS, ts: str | None = None
) -> DataFrame:
    """The return RMSE gauge stays above the limit for the hold time; an episode ends at the next good value."""
    gauge = rmse_gauge(realized, step_s, ts)
    by_time = Window.partitionBy("symbol").orderBy("_at")
    good_so_far = F.count_if(F.col("rmse_return") <= limit).over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    marked = gauge.withColumns({"_episode": good_so_far, "_until": F.coalesce(F.lead("_at").over(by_time), F.col("_at"))})
    return (
        marked.where(F.col("rmse_return") > limit)
        .groupBy("symbol", "_episode")
        .agg(F.min("_at").alias("_from"), F.max("_until").alias("_to"), F.max("rmse_return").alias("peak_rmse"))
        .where(F.col("_to") - F.col("_from") >= hold_s)
        .select(
            "symbol",
            F.timestamp_seconds("_from").alias("pending_since"),
            F.timestamp_seconds(F.col("_from") + hold_s).alias("firing_since"),
            F.timestamp_seconds("_to").alias("until"),
            "peak_rmse",
        )
    )


# Yellow and red limits of the health panels; fixed values.
HEALTH_LIMITS = {"rmse": (100.0, 500.0), "mae": (50.0, 200.0)}


def health_bands(accuracy: DataFrame) -> DataFrame:
    """Traffic light per symbol for the latest price RMSE and MAE."""

    def band(metric: str) -> Column:
        yellow, red = HEALTH_LIMITS[metric]
        value = F.col(metric)
        return F.when(value >= red, "red").when(value >= yellow, "yellow").when(value.isNotNull(), "green")

    return accuracy.select("symbol", "rmse", "mae", *[band(m).alias(f"{m}_band") for m in HEALTH_LIMITS])
