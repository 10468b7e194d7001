"""Request-log roll-ups and alerts over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.operators import monitor, predictions
from tickloom.operators.monitor import LATENCY_BOUNDS
from tickloom.plans.catalog import query
from tickloom.plans.fixtures import LOG, REALIZED, Tables, q6

_MINUTE = "time_bucket(INTERVAL 1 MINUTE, ts)"


@query(
    "request_rate",
    f"WITH {LOG} SELECT {_MINUTE} AS window_start, symbol, status, {q6('count(*) / 60')} AS rate FROM request_log GROUP BY 1, 2, 3",
)
def request_rate(t: Tables) -> DataFrame:
    return monitor.request_rate(t.request_log())


@query(
    "error_rate_by_type",
    f"""WITH {LOG} SELECT {_MINUTE} AS window_start, symbol, error_type, {q6('count(*) / 60')} AS rate
    FROM request_log WHERE error_type IS NOT NULL GROUP BY 1, 2, 3""",
)
def error_rate_by_type(t: Tables) -> DataFrame:
    return monitor.error_rate_by_type(t.request_log())


def _bounds_sql() -> str:
    rows = [f"({i}, {b}::DOUBLE, {([0.0] + LATENCY_BOUNDS)[i]}::DOUBLE, '{b}')" for i, b in enumerate(LATENCY_BOUNDS)]
    return f"bounds(i, hi, lo, le) AS (VALUES {', '.join(rows)}, (10, CAST('inf' AS DOUBLE), 5.0::DOUBLE, '+Inf'))"


@query(
    "latency_histogram",
    f"""WITH {LOG}, {_bounds_sql()} SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, symbol, le,
    count(*) FILTER (latency_s <= hi) AS requests FROM request_log, bounds GROUP BY ALL""",
)
def latency_histogram(t: Tables) -> DataFrame:
    return monitor.latency_histogram(t.request_log())


def _quantile_sql(q: float, source: str, by: str, name: str) -> str:
    """CTE: quantile per group of ``source`` (by, i, lo, hi, requests), the first bound reaching the rank counts."""
    return f"""{name} AS (
      SELECT {by}, CASE WHEN i = 10 THEN 5.0 ELSE lo + (hi - lo) * (rank - below) / (requests - below) END AS value
      FROM (SELECT *, {q} * max(requests) OVER (PARTITION BY {by}) AS rank,
              coalesce(lag(requests) OVER (PARTITION BY {by} ORDER BY i), 0) AS below FROM {source})
      WHERE requests >= rank QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY i) = 1)"""


@query(
    "latency_quantiles",
    f"""WITH {LOG}, {_bounds_sql()}, counts AS (
      SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, symbol, i, lo, hi, count(*) FILTER (latency_s <= hi) AS requests
      FROM request_log, bounds GROUP BY ALL),
    {_quantile_sql(0.5, 'counts', 'window_start, symbol', 'q50')}, {_quantile_sql(0.95, 'counts', 'window_start, symbol', 'q95')},
    {_quantile_sql(0.99, 'counts', 'window_start, symbol', 'q99')}
    SELECT window_start, symbol, {q6('q50.value')} AS p50, {q6('q95.value')} AS p95, {q6('q99.value')} AS p99
    FROM q50 JOIN q95 USING (window_start, symbol) JOIN q99 USING (window_start, symbol)""",
)
def latency_quantiles(t: Tables) -> DataFrame:
    """Hourly, since the test data has few requests per minute."""
    return monitor.latency_quantiles(t.request_log(), 3600)


# --- alerts: evaluated every 30 seconds over the last minutes --------------------------------------


def _evaluations(range_s: int) -> str:
    """Each request counts at every evaluation step whose range covers it."""
    return f"""evals AS (
      SELECT *, unnest(range(step + 1, step + 1 + {range_s // 30})) * 30 AS t
      FROM (SELECT *, epoch_us(ts) // 30000000 AS step FROM request_log))"""


def _episodes(source: str, hold_s: int = 300) -> str:
    return f"""
    SELECT symbol, make_timestamp(min(t) * 1000000) AS pending_since, make_timestamp((min(t) + {hold_s}) * 1000000) AS firing_since,
      make_timestamp(max(t) * 1000000) AS last_true
    FROM (SELECT *, t // 30 - row_number() OVER (PARTITION BY symbol ORDER BY t) AS episode FROM {source})
    GROUP BY symbol, episode HAVING max(t) - min(t) >= {hold_s}"""


@query(
    "alert_latency",
    f"""WITH {LOG}, {_bounds_sql()}, {_evaluations(300)}, counts AS (
      SELECT t, symbol, i, lo, hi, count(*) FILTER (latency_s <= hi) AS requests FROM evals, bounds GROUP BY ALL),
    {_quantile_sql(0.99, 'counts', 't, symbol', 'q99')}, breaches AS (SELECT * FROM q99 WHERE value > 1.0)
    {_episodes('breaches')}""",
)
def alert_latency(t: Tables) -> DataFrame:
    return monitor.latency_alerts(t.request_log())


@query(
    "alert_error_ratio",
    f"""WITH {LOG}, {_evaluations(300)}, breaches AS (
      SELECT t, symbol FROM evals GROUP BY t, symbol HAVING count(*) FILTER (status = 'error') / count(*) > 0.05)
    {_episodes('breaches')}""",
)
def alert_error_ratio(t: Tables) -> DataFrame:
    return monitor.error_ratio_alerts(t.request_log())


@query(
    "alert_rmse",
    f"""WITH {REALIZED}, steps AS (
      SELECT symbol, (epoch_us(realized_at) // 30000000 + 1) * 30 AS t, sum(realized_return_error * realized_return_error) AS sq, count(*) AS n
      FROM realized WHERE realized_return_error IS NOT NULL GROUP BY ALL),
    gauge AS (SELECT symbol, t, sqrt(sum(sq) OVER w / sum(n) OVER w) AS rmse, coalesce(lead(t) OVER w, t) AS until_t FROM steps
      WINDOW w AS (PARTITION BY symbol ORDER BY t)),
    marked AS (SELECT *, count(*) FILTER (rmse <= 0.0195) OVER (PARTITION BY symbol ORDER BY t) AS episode FROM gauge)
    SELECT symbol, make_timestamp(min(t) * 1000000) AS pending_since, make_timestamp((min(t) + 300) * 1000000) AS firing_since,
      make_timestamp(max(until_t) * 1000000) AS until, {q6('max(rmse)')} AS peak_rmse
    FROM marked WHERE rmse > 0.0195 GROUP BY symbol, episode HAVING max(until_t) - min(t) >= 300""",
)
def alert_rmse(t: Tables) -> DataFrame:
    return monitor.rmse_alerts(t.realized(), limit=0.0195)


@query(
    "health_bands",
    f"""WITH {REALIZED}, acc AS (SELECT symbol, sqrt(avg(realized_error * realized_error)) AS rmse, avg(abs(realized_error)) AS mae
      FROM realized GROUP BY symbol)
    SELECT symbol, {q6('rmse')} AS rmse, {q6('mae')} AS mae,
      CASE WHEN rmse >= 500 THEN 'red' WHEN rmse >= 100 THEN 'yellow' WHEN rmse IS NOT NULL THEN 'green' END AS rmse_band,
      CASE WHEN mae >= 200 THEN 'red' WHEN mae >= 50 THEN 'yellow' WHEN mae IS NOT NULL THEN 'green' END AS mae_band FROM acc""",
)
def health_bands(t: Tables) -> DataFrame:
    return monitor.health_bands(predictions.accuracy(t.realized()))
