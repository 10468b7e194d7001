"""Labels, splits, baselines, gate and back-test over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import price_from_return
from tickloom.operators import backtest, labels
from tickloom.operators.labels import TARGET
from tickloom.plans import training
from tickloom.plans.catalog import query
from tickloom.plans.fixtures import BACKTEST, PREPARED, TIE, Tables, q6
from tickloom.schemas import MODEL_FEATURES, TICK_DERIVED

_ROW = ["event_id", "symbol", "event_ts"]


def _shown(columns) -> str:
    return ", ".join(f"{q6(c)} AS {c}" for c in columns)


_LABELLED = ["price", "volume", *TICK_DERIVED, "target_price", TARGET]


@query("prepare_training", f"WITH {PREPARED} SELECT event_id, symbol, event_ts, {_shown(_LABELLED)} FROM prepared")
def prepare_training(t: Tables) -> DataFrame:
    return t.prepared().select(*_ROW, *_LABELLED)


_SPLIT = """, ranked AS (SELECT *, percent_rank() OVER (ORDER BY event_ts) AS r FROM prepared),
splits AS (SELECT *, CASE WHEN r <= 0.7 THEN 'train' WHEN r <= CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE) THEN 'val' ELSE 'test' END AS split FROM ranked)"""


@query("chronological_split", f"WITH {PREPARED}{_SPLIT} SELECT event_id, symbol, event_ts, split FROM splits")
def chronological_split(t: Tables) -> DataFrame:
    return labels.with_split(t.prepared()).select(*_ROW, "split")


@query(
    "split_counts",
    f"WITH {PREPARED}{_SPLIT} SELECT split, count(*) AS n, min(event_ts) AS first_ts, max(event_ts) AS last_ts FROM splits GROUP BY 1",
)
def split_counts(t: Tables) -> DataFrame:
    return labels.with_split(t.prepared()).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts")
    )


@query(
    "trade_split_counts",
    """WITH ranked AS (SELECT l_shipdate, percent_rank() OVER (ORDER BY l_shipdate) AS r FROM lineitem)
    SELECT CASE WHEN r <= 0.7 THEN 'train' WHEN r <= CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE) THEN 'val' ELSE 'test' END AS split, count(*) AS n
    FROM ranked GROUP BY 1""",
)
def trade_split_counts(t: Tables) -> DataFrame:
    """A table where many rows share each time: they must stay on one side of a cut."""
    return labels.with_split(t.trade_ticks().select("event_ts")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


_CHUNKS = """, chunked AS (
  SELECT *, CAST(floor(0) AS BIGINT) + (r >= 1 / 5::DOUBLE)::BIGINT + (r >= 2 / 5::DOUBLE)::BIGINT
            + (r >= 3 / 5::DOUBLE)::BIGINT + (r >= 4 / 5::DOUBLE)::BIGINT AS chunk
  FROM (SELECT *, percent_rank() OVER (ORDER BY event_ts) AS r FROM prepared) WHERE r < 1.0)"""


@query("walk_forward_windows", f"WITH {PREPARED}{_CHUNKS} SELECT event_id, symbol, event_ts, chunk FROM chunked")
def walk_forward_windows(t: Tables) -> DataFrame:
    return labels.walk_forward_chunks(t.prepared(), 5, compat=True).select(*_ROW, "chunk")


_ALL_CHUNKS = _CHUNKS.replace(" WHERE r < 1.0", "")


@query("walk_forward_windows_all", f"WITH {PREPARED}{_ALL_CHUNKS} SELECT event_id, symbol, event_ts, chunk FROM chunked")
def walk_forward_windows_all(t: Tables) -> DataFrame:
    """The chunks of all rows; the compatible form above leaves the newest one out."""
    return labels.walk_forward_chunks(t.prepared(), 5).select(*_ROW, "chunk")


_MA = "avg(price_return) OVER (PARTITION BY {by}symbol ORDER BY event_ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


@query(
    "walk_forward_baselines",
    f"""WITH {PREPARED}{_CHUNKS}, held AS (
      SELECT *, {_MA.format(by='chunk, ')} AS ma FROM (
        SELECT *, percent_rank() OVER (PARTITION BY chunk ORDER BY event_ts) AS cr FROM chunked) WHERE cr > 0.7)
    SELECT chunk, count(*) AS n_val, {q6('sqrt(avg(target_return * target_return))')} AS zero_return_rmse,
      {q6('sqrt(avg((target_return - ma) * (target_return - ma)))')} AS ma_rmse FROM held GROUP BY chunk""",
)
def walk_forward_baselines(t: Tables) -> DataFrame:
    return training.walk_forward_baselines(t.prepared(), 5, 0.7, TIE, compat=True)


@query(
    "walk_forward_baselines_all",
    f"""WITH {PREPARED}{_ALL_CHUNKS}, held AS (
      SELECT *, {_MA.format(by='chunk, ')} AS ma FROM (
        SELECT *, percent_rank() OVER (PARTITION BY chunk ORDER BY event_ts) AS cr FROM chunked) WHERE cr > 0.7)
    SELECT chunk, count(*) AS n_val, {q6('sqrt(avg(target_return * target_return))')} AS zero_return_rmse,
      {q6('sqrt(avg((target_return - ma) * (target_return - ma)))')} AS ma_rmse FROM held GROUP BY chunk""",
)
def walk_forward_baselines_all(t: Tables) -> DataFrame:
    return training.walk_forward_baselines(t.prepared(), 5, 0.7, TIE)


@query("ma_baseline", f"WITH {PREPARED} SELECT event_id, symbol, event_ts, {q6(_MA.format(by=''))} AS prediction FROM prepared")
def ma_baseline(t: Tables) -> DataFrame:
    return t.prepared(prediction=5).select(*_ROW, "prediction")


def _metrics_sql(label: str, prediction: str, source: str = "prepared", by: str = "") -> str:
    group = f" GROUP BY {by}" if by else ""
    by = f"{by}, " if by else ""
    return f"""SELECT {by}count(*) AS n, {q6('sqrt(avg((y - p) * (y - p)))')} AS rmse, {q6('avg((y - p) * (y - p))')} AS mse,
      {q6('avg(abs(y - p))')} AS mae, {q6('1 - avg((y - p) * (y - p)) / var_pop(y)')} AS r2,
      {q6('avg((p - m) * (p - m))')} AS var
    FROM (SELECT *, avg(y) OVER ({'PARTITION BY ' + by.rstrip(', ') if by else ''}) AS m FROM (
      SELECT *, {label} AS y, {prediction} AS p FROM {source}) WHERE y IS NOT NULL AND p IS NOT NULL){group}"""


@query("baseline_persistence", f"WITH {PREPARED} {_metrics_sql('target_price', 'price')}")
def baseline_persistence(t: Tables) -> DataFrame:
    return labels.persistence_baseline(t.prepared())


@query("baseline_zero_return", f"WITH {PREPARED} {_metrics_sql(TARGET, '0.0::DOUBLE')}")
def baseline_zero_return(t: Tables) -> DataFrame:
    return labels.zero_return_baseline(t.prepared())


_WITH_MA = f", averaged AS (SELECT *, {_MA.format(by='')} AS ma FROM prepared)"


@query("baseline_moving_average", f"WITH {PREPARED}{_WITH_MA} {_metrics_sql(TARGET, 'ma', 'averaged')}")
def baseline_moving_average(t: Tables) -> DataFrame:
    return labels.regression_metrics(t.prepared(_ma=5), TARGET, "_ma")


@query("regression_metrics", f"WITH {PREPARED} {_metrics_sql('target_price', 'ma20', 'prepared', 'symbol')}")
def regression_metrics(t: Tables) -> DataFrame:
    """How well the 20-tick mean predicts the next price, per symbol."""
    return labels.regression_metrics(t.prepared(), "target_price", "ma20", ("symbol",))


def _rmse(prediction: str) -> str:
    return f"sqrt(avg((target_return - {prediction}) * (target_return - {prediction})) FILTER ({prediction} IS NOT NULL))"


@query(
    "promotion_gate",
    f"""WITH {PREPARED}, averaged AS (SELECT *, {_MA.format(by='')} AS ma5_return,
        {_MA.format(by='').replace('4 PRECEDING', '19 PRECEDING')} AS ma20_return FROM prepared),
    metrics AS (SELECT symbol, {_rmse('ma20_return')} AS test_rmse, sqrt(avg(target_return * target_return)) AS zero_return_rmse,
        {_rmse('ma5_return')} AS production_rmse FROM averaged GROUP BY symbol)
    SELECT symbol, {_shown(['test_rmse', 'zero_return_rmse', 'production_rmse'])},
      test_rmse < zero_return_rmse AS beats_baseline,
      (production_rmse - test_rmse) / production_rmse * 100 >= 0 AS beats_production,
      test_rmse < zero_return_rmse AND (production_rmse - test_rmse) / production_rmse * 100 >= 0 AS promotable
    FROM metrics""",
)
def promotion_gate(t: Tables) -> DataFrame:
    """Would a 20-tick average replace a 5-tick average, per symbol?"""
    rows = t.prepared(_p20=20, _p5=5)

    def rmse(prediction, name):
        error = F.col(TARGET) - prediction
        return F.sqrt(F.avg(error * error)).alias(name)

    metrics = rows.groupBy("symbol").agg(
        rmse(F.col("_p20"), "test_rmse"), rmse(F.lit(0.0), "zero_return_rmse"), rmse(F.col("_p5"), "production_rmse")
    )
    return labels.promotion_gate(metrics)


@query(
    "return_to_price",
    f"WITH {PREPARED} SELECT event_id, symbol, {q6('price * (1 + price_return)')} AS predicted_price FROM prepared",
)
def return_to_price(t: Tables) -> DataFrame:
    rows = t.prepared()
    return rows.select("event_id", "symbol", price_from_return(F.col("price"), F.col("price_return")).alias("predicted_price"))


@query(
    "gbt_test_rows",
    f"""WITH {PREPARED}, ranked AS (SELECT *, percent_rank() OVER (ORDER BY event_ts) AS r FROM prepared)
    SELECT event_id, symbol, event_ts, {q6(TARGET)} AS {TARGET}, TRUE AS finite FROM ranked
    WHERE r > CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE) AND {" AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)}""",
)
def gbt_test_rows(t: Tables) -> DataFrame:
    """Which rows the model predicts, and that it gives each a number."""
    out = gbt_predictions(t)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return out.select(*_ROW, TARGET, finite.alias("finite"))


@query("gbt_predictions")
def gbt_predictions(t: Tables) -> DataFrame:
    train, _, test = labels.chronological_split(t.prepared())
    model = training.gbt_pipeline().fit(train)
    return model.transform(test).select(*_ROW, "prediction", TARGET)


# --- back-test ------------------------------------------------------------------------------------


@query(
    "signals",
    f"WITH {BACKTEST} SELECT event_id, symbol, event_ts, CAST(signal AS BIGINT) AS signal, "
    f"{q6('signal * realized_return')} AS strategy_return FROM bt",
)
def signals(t: Tables) -> DataFrame:
    return backtest.with_signal(t.backtest_input()).select(*_ROW, "signal", "strategy_return")


@query(
    "equity_curve",
    f"WITH {BACKTEST} SELECT event_id, symbol, event_ts, {_shown(['equity', 'peak', 'drawdown'])} FROM curve",
)
def equity_curve(t: Tables) -> DataFrame:
    return backtest.equity_curve(t.backtest_slices(), ("symbol",), ("event_ts", *TIE)).select(*_ROW, "equity", "peak", "drawdown")


def _summary_sql(by: str, source: str) -> str:
    group, key = (f" GROUP BY {by}", f"{by}, ") if by else ("", "")
    return f"""SELECT {key}count(*) AS n_trades, {q6('product(1 + strategy_return) - 1')} AS total_return,
      {q6('CASE WHEN stddev_samp(strategy_return) > 0 THEN avg(strategy_return) / stddev_samp(strategy_return) * sqrt(252) ELSE 0 END')} AS sharpe_ratio,
      {q6('min(drawdown)')} AS max_drawdown,
      {q6('avg(CASE WHEN strategy_return > 0 THEN 1.0 ELSE 0.0 END)')} AS win_rate,
      {q6("CASE WHEN sum(least(strategy_return, 0)) < 0 THEN sum(greatest(strategy_return, 0)) / abs(sum(least(strategy_return, 0))) ELSE CAST('inf' AS DOUBLE) END")} AS profit_factor,
      {q6('avg(CASE WHEN (predicted_return > 0) = (realized_return > 0) THEN 1.0 ELSE 0.0 END)')} AS directional_accuracy,
      {q6('product(1 + realized_return) - 1')} AS buy_and_hold_return
    FROM {source}{group}"""


@query("backtest_summary", f"WITH {BACKTEST} {_summary_sql('symbol', 'curve')}")
def backtest_summary(t: Tables) -> DataFrame:
    return backtest.backtest_summary(t.backtest_slices(), ("symbol",), ("event_ts", *TIE))


_ONE_ACCOUNT = """, all_eq AS (SELECT * EXCLUDE (equity), product(1 + strategy_return) OVER (
  ORDER BY event_ts, symbol, event_id ROWS UNBOUNDED PRECEDING) AS equity FROM eq),
all_curve AS (SELECT *, (equity - peak) / peak AS drawdown FROM (
  SELECT *, max(equity) OVER (ORDER BY event_ts, symbol, event_id ROWS UNBOUNDED PRECEDING) AS peak FROM all_eq))"""


@query("backtest_one_account", f"WITH {BACKTEST}{_ONE_ACCOUNT} {_summary_sql('', 'all_curve')}")
def backtest_one_account(t: Tables) -> DataFrame:
    """All symbols traded in time order as one account."""
    return backtest.backtest_summary(t.backtest_input(), (), ("event_ts", "symbol", *TIE))
