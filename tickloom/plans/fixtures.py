"""The given tables seen as market data, so every operator has an input of growing size.

Each view has the same definition in SQL, for comparing results with another engine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import labels, predictions
from tickloom.operators.ingest import validate_events
from tickloom.operators.ordered import SLICE, Ordering, finish
from tickloom.session import use_utc
from tickloom.sources.scratch import settled

TIE = ["event_id"]
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
TRADE_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def latest_time(df: DataFrame, ts: str = "event_ts"):
    """The newest time of a table as a one-value subquery."""
    return df.agg(F.max(ts)).scalar()


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    sf_dir: str

    def __post_init__(self):
        use_utc(self.spark)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def market_events(self) -> DataFrame:
        """``events`` as ticks: event type = symbol, value = price, ``props.k`` = volume."""
        ts = F.col("ts").cast("timestamp")
        source = F.when(F.col("user_id") % 2 == 0, "feed_a").otherwise("feed_b")
        ticks = self.read("events").select(
            "event_id",
            F.col("event_type").alias("symbol"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").cast("double").alias("volume"),
            F.date_format(ts, ISO_MICROS).alias("timestamp"),
            source.alias("source"),
            ts.alias("event_ts"),
        )
        key = F.concat_ws("-", "symbol", "timestamp", "source")
        return ticks.withColumns({"idempotency_key": key, "received_at": F.col("timestamp")})

    def calm_events(self) -> DataFrame:
        """The same with prices around 100, so returns are small."""
        return self.market_events().withColumn("price", 100 + F.col("price") / 100)

    def duplicated_events(self) -> DataFrame:
        """Some rows arrive twice with the same key, the copy one second later."""
        ticks = self.market_events()
        copies = ticks.where(F.col("event_id") % 10 == 0)
        later = F.col("event_ts") + F.expr("interval 1 second")
        copies = copies.withColumns({"event_ts": later, "timestamp": F.date_format(later, ISO_MICROS)})
        return ticks.unionByName(copies)

    def bad_events(self) -> DataFrame:
        """Ticks with impossible prices, volumes and times mixed in."""
        n = F.col("event_id")
        price = F.when(n % 97 == 0, -1.0).when(n % 79 == 0, float("nan")).otherwise(F.col("price"))
        return self.market_events().withColumns(
            {
                "price": price,
                "volume": F.when(n % 89 == 0, -1.0).otherwise(F.col("volume")),
                "timestamp": F.when(n % 83 == 0, "").otherwise(F.col("timestamp")),
            }
        )

    def trade_ticks(self) -> DataFrame:
        """``lineitem`` as ticks: three symbols, one time per day, so many ties."""
        return self.read("lineitem").select(
            F.col("l_returnflag").alias("symbol"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("volume"),
            F.col("l_shipdate").cast("timestamp").alias("event_ts"),
            *TRADE_TIE,
        )

    def raw_trades(self) -> DataFrame:
        """Exchange messages as JSON text: flat ones and nested ones, by event id."""
        ticks = self.market_events()
        flat = F.to_json(
            F.struct(
                F.lit("trade").alias("e"),
                F.col("symbol").alias("s"),
                F.col("price").cast("string").alias("p"),
                F.col("volume").cast("string").alias("q"),
                F.unix_millis("event_ts").alias("T"),
            )
        )
        trade = F.struct(
            F.concat(F.lit("BINANCE:"), "symbol").alias("s"),
            F.col("price").alias("p"),
            F.col("volume").alias("v"),
            F.unix_millis("event_ts").alias("t"),
        )
        nested = F.to_json(F.struct(F.lit("trade").alias("type"), F.array(trade, trade).alias("data")))
        is_flat = F.col("event_id") % 2 == 0
        return ticks.select(
            "event_id",
            F.when(is_flat, "binance").otherwise("finnhub").alias("source"),
            F.when(is_flat, flat).otherwise(nested).alias("payload"),
        )

    def prepared(self, **averages: int) -> DataFrame:
        """Labelled calm ticks; ``averages`` adds means of so many last returns."""
        return labels.prepare_training(self.calm_events(), TIE, keep=TIE, averages=averages)

    def predictions(self) -> DataFrame:
        """One prediction per calm tick: the mean of the last five returns."""
        return self.predictions_from(self.scored(self.calm_events()))

    def scored(self, ticks: DataFrame) -> DataFrame:
        """Features of ticks and the mean of the last five returns."""
        from tickloom.operators.features import tick_features

        return tick_features(ticks, TIE, keep=TIE, averages={"predicted_return": 5})

    def predictions_from(self, scored: DataFrame) -> DataFrame:
        return predictions.prediction_rows(scored.where(F.col("predicted_return").isNotNull()), "event_id")

    def valid_ticks(self) -> DataFrame:
        """The calm ticks that have features, as a stored table, so that their text is parsed once."""
        return settled(validate_events(self.calm_events()).select("symbol", "event_ts", *TIE, "price", "volume"))

    def realized(self) -> DataFrame:
        return predictions.realize_fifo(self.predictions(), self.calm_events(), TIE, "event_id")

    def backtest_slices(self) -> Ordering:
        """Predicted and realized returns per calm tick, in slices by symbol and tick order."""
        scored = labels.prepared_slices(self.calm_events(), TIE, TIE, {"predicted_return": 5})
        shown = ["symbol", "event_ts", *TIE, "predicted_return", F.col(labels.TARGET).alias("realized_return"), SLICE]
        return scored.map(lambda rows: rows.where(F.col("predicted_return").isNotNull()).select(*shown))

    def backtest_input(self) -> DataFrame:
        return finish(self.backtest_slices())

    def request_log(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        failed = F.col("event_type") == "error"
        return self.read("events").select(
            F.col("ts").cast("timestamp").alias("ts"),
            F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("symbol"),
            F.when(failed, "error").otherwise("ok").alias("status"),
            F.when(failed, F.when(k % 2 == 0, "model_error").otherwise("rate_limited")).alias("error_type"),
            (F.col("value") / 100).alias("latency_s"),
        )

    def drift_state(self) -> DataFrame:
        """Last trigger per symbol: ten minutes per rank before the newest event; the first symbol has none."""
        newest = self.market_events().groupBy("symbol").agg(F.max("event_ts").alias("_seen"))
        from pyspark.sql import Window

        rank = F.row_number().over(Window.orderBy("symbol"))  # one row per symbol
        ranked = newest.withColumn("_rank", rank).where(F.col("_rank") > 1)
        now = latest_time(self.market_events())
        return ranked.select("symbol", (now - F.make_dt_interval(mins=F.col("_rank") * 10)).alias("last_trigger_time"))

    def version_log(self) -> DataFrame:
        """``orders`` as model history: priority = model, customer = version, order status = stage."""
        stage = (
            F.when(F.col("o_orderstatus") == "P", "Staging")
            .when(F.col("o_orderstatus") == "O", "Production")
            .otherwise("Archived")
        )
        return self.read("orders").select(
            F.col("o_orderpriority").alias("model"),
            F.col("o_custkey").cast("long").alias("version"),
            stage.alias("stage"),
            (F.col("o_totalprice") / 1e6).alias("test_rmse"),
            F.col("o_orderdate").cast("timestamp").alias("at"),
            F.col("o_orderkey").cast("long").alias("seq"),
        )


# --- the same views in SQL ------------------------------------------------------------------------


def q6(expression: str) -> str:
    """Round for comparing engines; the small shift keeps decimal ties away from the rounding edge."""
    return f"round(({expression}) + 0.00000001234567, 6)"


ME = """me AS (
  SELECT *, symbol || '-' || timestamp || '-' || source AS idempotency_key FROM (
    SELECT event_id, event_type AS symbol, value AS price,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS volume,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
           CASE WHEN user_id % 2 = 0 THEN 'feed_a' ELSE 'feed_b' END AS source,
           ts AS event_ts
    FROM events))"""
CALM = ME + """, calm AS (SELECT * REPLACE (100 + price / 100 AS price) FROM me)"""
DUP = ME + """, dup AS (
  SELECT event_id, symbol, price, volume, timestamp, source, event_ts, idempotency_key FROM me
  UNION ALL
  SELECT event_id, symbol, price, volume, strftime(event_ts + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%fZ'), source,
         event_ts + INTERVAL 1 SECOND, idempotency_key
  FROM me WHERE event_id % 10 = 0)"""
BAD = ME + """, bad AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 97 = 0 THEN -1.0 WHEN event_id % 79 = 0 THEN CAST('nan' AS DOUBLE) ELSE price END AS price,
    CASE WHEN event_id % 89 = 0 THEN -1.0 ELSE volume END AS volume,
    CASE WHEN event_id % 83 = 0 THEN '' ELSE timestamp END AS timestamp)
  FROM me)"""
TRADES = """tt AS (
  SELECT l_returnflag AS symbol, l_extendedprice AS price, l_quantity AS volume, l_shipdate AS event_ts,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity
  FROM lineitem)"""
LOG = """request_log AS (
  SELECT ts, 's' || (user_id % 3) AS symbol,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
         CASE WHEN event_type = 'error' THEN
           CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 2 = 0 THEN 'model_error' ELSE 'rate_limited' END
         END AS error_type,
         value / 100 AS latency_s
  FROM events)"""
VALID = "price > 0 AND NOT isnan(price) AND volume >= 0 AND NOT isnan(volume) AND event_ts IS NOT NULL"


def features_sql(source: str, tie: str, name: str = "feat", extra: str = "") -> str:
    """CTEs computing the tick features of ``source``."""
    return f"""
{name}_w AS (
  SELECT *, lag(price) OVER w AS pp, lag(volume) OVER w AS pv,
         avg(price) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma5,
         avg(price) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma20,
         sum(price * volume) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS turnover,
         sum(volume) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS traded,
         max(price) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
           - min(price) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS price_range,
         lead(price) OVER w AS target_price
  FROM {source} WHERE {VALID}
  WINDOW w AS (PARTITION BY symbol ORDER BY event_ts, {tie})),
{name}_v AS (
  SELECT *, price - pp AS price_change, CASE WHEN pp > 0 THEN (price - pp) / pp END AS price_return,
         volume - pv AS volume_change, CASE WHEN traded <> 0 THEN turnover / traded END AS vwap
  FROM {name}_w),
{name} AS (
  SELECT *, ma5 / price AS ma5_ratio, ma20 / price AS ma20_ratio, vwap / price AS vwap_ratio,
         price_range / price AS price_range_ratio, (target_price - price) / price AS target_return{extra}
  FROM {name}_v)"""


PREPARED = CALM + "," + features_sql("calm", "event_id") + """,
prepared AS (SELECT * FROM feat WHERE target_price IS NOT NULL)"""
PREDICTED = CALM + "," + features_sql("calm", "event_id") + """,
pred AS (SELECT * FROM (
  SELECT event_id AS id, event_ts AS timestamp, symbol, price AS current_price,
         avg(price_return) OVER (PARTITION BY symbol ORDER BY event_ts, event_id
                                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS predicted_return,
         price_return, volume_change, ma5_ratio, ma20_ratio, vwap_ratio, price_range_ratio
  FROM feat) WHERE predicted_return IS NOT NULL),
predictions AS (SELECT *, current_price * (1 + predicted_return) AS predicted_price, 'v1' AS model_version FROM pred)"""
# Predictions and prices come at the same times here, so first-in-first-out means: the next prediction's price.
REALIZED = PREDICTED + """,
realized AS (
  SELECT *, actual - predicted_price AS realized_error,
         (actual - current_price) / current_price - predicted_return AS realized_return_error
  FROM (SELECT *, lead(current_price) OVER w AS actual, lead(timestamp) OVER w AS realized_at FROM predictions
        WINDOW w AS (PARTITION BY symbol ORDER BY timestamp, id)))"""
BACKTEST = PREPARED + """,
bt AS (SELECT *, CASE WHEN predicted_return > 0 THEN 1 ELSE -1 END AS signal FROM (
  SELECT symbol, event_ts, event_id, target_return AS realized_return,
         avg(price_return) OVER (PARTITION BY symbol ORDER BY event_ts, event_id
                                 ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS predicted_return
  FROM prepared) WHERE predicted_return IS NOT NULL),
eq AS (
  SELECT *, signal * realized_return AS strategy_return,
         10000.0 * product(1 + signal * realized_return) OVER (
           PARTITION BY symbol ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS equity
  FROM bt),
curve AS (
  SELECT *, (equity - peak) / peak AS drawdown FROM (
    SELECT *, max(equity) OVER (PARTITION BY symbol ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS peak
    FROM eq))"""
VERSIONS = """vlog AS (
  SELECT o_orderpriority AS model, CAST(o_custkey AS BIGINT) AS version,
         CASE o_orderstatus WHEN 'P' THEN 'Staging' WHEN 'O' THEN 'Production' ELSE 'Archived' END AS stage,
         o_totalprice / 1e6 AS test_rmse, o_orderdate AS changed_at, CAST(o_orderkey AS BIGINT) AS seq
  FROM orders),
folded AS (
  SELECT l.model, l.version,
         CASE WHEN l.stage = 'Production' AND l.version <> n.version THEN 'Archived' ELSE l.stage END AS stage,
         l.test_rmse,
         CASE WHEN l.stage = 'Production' AND l.version <> n.version THEN n.changed_at ELSE l.changed_at END AS updated_at, l.seq
  FROM (SELECT * FROM vlog QUALIFY row_number() OVER (PARTITION BY model, version ORDER BY changed_at DESC, seq DESC) = 1) l
  LEFT JOIN (SELECT * FROM vlog WHERE stage = 'Production'
             QUALIFY row_number() OVER (PARTITION BY model ORDER BY changed_at DESC, seq DESC) = 1) n USING (model))"""
