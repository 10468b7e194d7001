"""Ingest, validation, tick features, time windows and lake layout over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators import drift, features, ingest, time_windows
from tickloom.plans.catalog import query
from tickloom.plans.fixtures import BAD, CALM, DUP, ME, TIE, TRADE_TIE, TRADES, VALID, Tables, features_sql, q6
from tickloom.schemas import MODEL_FEATURES, TICK_DERIVED, TICK_FEATURES
from tickloom.sources import lake

EVENT = ["symbol", "price", "volume", "timestamp", "source", "idempotency_key"]
_EVENT_SQL = f"symbol, {q6('price')} AS price, {q6('volume')} AS volume, timestamp, source, idempotency_key"


# --- ingest ---------------------------------------------------------------------------------------


@query("parse_ticks_json", f"WITH {ME} SELECT event_id, {_EVENT_SQL} FROM me")
def parse_ticks_json(t: Tables) -> DataFrame:
    ticks = t.market_events()
    texts = ticks.select("event_id", F.to_json(F.struct(*EVENT, "received_at")).alias("value"))
    return ingest.parse_ticks_json(texts, keep=["event_id"]).select("event_id", *EVENT)


@query("kafka_projection", f"WITH {ME} SELECT symbol AS key, event_id, {_EVENT_SQL} FROM me")
def kafka_projection(t: Tables) -> DataFrame:
    """Build the messages and read them back, so that text formats of numbers do not matter."""
    messages = ingest.to_messages(t.market_events(), ["event_id", *EVENT])
    body = F.from_json("value", "event_id long, symbol string, price double, volume double, timestamp string, source string, idempotency_key string")
    return messages.select("key", body.alias("m")).select("key", "m.*")


_ADAPTED = """SELECT event_id, symbol, {price} AS price, {volume} AS volume,
  CASE WHEN millis % 1000 = 0 THEN strftime(make_timestamp(millis * 1000), '%Y-%m-%dT%H:%M:%SZ')
       ELSE strftime(make_timestamp(millis * 1000), '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp, {reason} AS reject_reason
FROM (SELECT *, epoch_us(event_ts) // 1000 AS millis FROM me)""".replace("{price}", q6("price")).replace("{volume}", q6("volume"))
_OUT = ["event_id", "symbol", "price", "volume", "timestamp", "reject_reason"]
_MISSING = """SELECT event_id, NULL AS symbol, NULL AS price, NULL AS volume, NULL AS timestamp,
  'missing trade fields' AS reject_reason FROM me"""


@query(
    "adapt_trades_flat",
    f"WITH {ME} {_ADAPTED.replace('{reason}', 'CAST(NULL AS VARCHAR)')} WHERE event_id % 2 = 0 "
    f"UNION ALL {_MISSING} WHERE event_id % 2 = 1",
)
def adapt_trades_flat(t: Tables) -> DataFrame:
    return ingest.adapt_flat_trades(t.raw_trades()).select(*_OUT)


@query(
    "adapt_trades_nested",
    f"WITH {ME} {_ADAPTED.replace('{reason}', 'CAST(NULL AS VARCHAR)')} WHERE event_id % 2 = 1 "
    f"UNION ALL {_MISSING} WHERE event_id % 2 = 0",
)
def adapt_trades_nested(t: Tables) -> DataFrame:
    return ingest.adapt_nested_trades(t.raw_trades()).select(*_OUT)


@query(
    "adapt_trades_nested_all",
    f"WITH {ME} SELECT a.*, n FROM ({_ADAPTED.replace('{reason}', 'CAST(NULL AS VARCHAR)')} WHERE event_id % 2 = 1) a, range(2) AS r(n) "
    f"UNION ALL SELECT *, 0 FROM ({_MISSING} WHERE event_id % 2 = 0)",
)
def adapt_trades_nested_all(t: Tables) -> DataFrame:
    """Every trade of a message; here each nested message holds the same trade twice."""
    trades = ingest.adapt_nested_trades(t.raw_trades(), explode_all=True)
    copies = Window.partitionBy("event_id").orderBy("symbol")
    return trades.select(*_OUT, (F.row_number().over(copies) - 1).alias("n"))


_PRICE, _VOLUME = "CAST(event_id % 500 + 1 AS VARCHAR)", "CAST(event_id % 90 AS VARCHAR)"
_MESSAGE = f"""CASE WHEN event_id % 101 = 0 THEN substr(whole, 1, 25) WHEN event_id % 103 = 0 THEN '' WHEN event_id % 107 = 0 THEN '{{}}'
  WHEN event_id % 109 = 0 THEN replace(whole, '"price":', '"price":-') WHEN event_id % 113 = 0 THEN replace(whole, timestamp, 'soon') ELSE whole END"""


@query(
    "dead_letters",
    f"""WITH {ME}, texts AS (SELECT event_id, timestamp, '{{"symbol":"' || symbol || '","price":' || {_PRICE} || ',"volume":' || {_VOLUME} ||
      ',"timestamp":"' || timestamp || '","source":"' || source || '"}}' AS whole FROM me)
    SELECT event_id, CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN 'not a JSON object' WHEN event_id % 107 = 0 THEN 'missing fields'
      WHEN event_id % 109 = 0 THEN 'price or volume out of range' ELSE 'unreadable timestamp' END AS reject_reason, md5({_MESSAGE}) AS payload_md5
    FROM texts WHERE event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 107 = 0 OR event_id % 109 = 0 OR event_id % 113 = 0""",
)
def dead_letters(t: Tables) -> DataFrame:
    """Messages cut short, empty, without fields or with impossible values, kept with what they said and why they went."""
    price, volume = (F.expr(x.replace("VARCHAR", "STRING")) for x in (_PRICE, _VOLUME))
    whole = F.concat(
        F.lit('{"symbol":"'), "symbol", F.lit('","price":'), price, F.lit(',"volume":'), volume,
        F.lit(',"timestamp":"'), "timestamp", F.lit('","source":"'), "source", F.lit('"}'),
    )
    messages = t.market_events().select("event_id", "timestamp", whole.alias("whole")).select("event_id", F.expr(_MESSAGE).alias("value"))
    decoded = ingest.decode_events(messages, keep=["event_id"])
    return ingest.rejected(decoded).select("event_id", "reject_reason", F.md5("payload").alias("payload_md5"))


@query("adapt_trades", f"WITH {ME} {_ADAPTED.replace('{reason}', 'CAST(NULL AS VARCHAR)')}")
def adapt_trades(t: Tables) -> DataFrame:
    return ingest.adapt_trades(t.raw_trades()).select(*_OUT)


_REASON = """CASE WHEN price <= 0 OR isnan(price) OR volume < 0 THEN 'price or volume out of range'
     WHEN timestamp = '' THEN 'empty timestamp' END"""


@query(
    "normalize_events",
    f"WITH {BAD} SELECT event_id, {_EVENT_SQL.replace('idempotency_key', '')} "
    f"symbol || '-' || timestamp || '-' || source AS idempotency_key FROM bad WHERE ({_REASON}) IS NULL",
)
def normalize_events(t: Tables) -> DataFrame:
    return ingest.accepted(ingest.normalize_events(t.bad_events(), F.col("source"))).select("event_id", *EVENT)


@query(
    "rejected_events",
    f"WITH {BAD} SELECT event_id, symbol, timestamp, {_REASON} AS reject_reason FROM bad WHERE ({_REASON}) IS NOT NULL",
)
def rejected_events(t: Tables) -> DataFrame:
    bad = ingest.rejected(ingest.normalize_events(t.bad_events(), F.col("source")))
    return bad.select("event_id", "symbol", "timestamp", "reject_reason")


_BAD_TS = BAD.replace("SELECT * REPLACE (", "SELECT * REPLACE (CASE WHEN event_id % 83 = 0 THEN NULL ELSE event_ts END AS event_ts,")


@query(
    "validate_events",
    f"WITH {_BAD_TS} SELECT event_id, symbol, {q6('price')} AS price, {q6('volume')} AS volume, event_ts "
    f"FROM bad WHERE {VALID}",
)
def validate_events(t: Tables) -> DataFrame:
    return ingest.validate_events(t.bad_events()).select("event_id", "symbol", "price", "volume", "event_ts")


@query(
    "validate_training",
    f"""WITH {BAD} SELECT event_id, symbol, {q6('price')} AS price, {q6('volume')} AS volume, timestamp FROM bad
    WHERE price > 0 AND NOT isnan(price) AND volume >= 0 AND timestamp <> ''""",
)
def validate_training(t: Tables) -> DataFrame:
    rows = ingest.validate_training_data(t.bad_events(), TIE)
    return rows.select("event_id", "symbol", "price", "volume", "timestamp")


@query(
    "dedup_first_by_key",
    f"""WITH {DUP} SELECT event_id, idempotency_key, timestamp, event_ts FROM dup
    QUALIFY row_number() OVER (PARTITION BY idempotency_key ORDER BY event_ts, event_id) = 1""",
)
def dedup_first_by_key(t: Tables) -> DataFrame:
    return ingest.dedup_by_key(t.duplicated_events(), order=TIE).select("event_id", "idempotency_key", "timestamp", "event_ts")


# --- tick features --------------------------------------------------------------------------------


def _features(t: Tables, columns: list[str]) -> DataFrame:
    typed = t.market_events().drop("timestamp")  # the event time is typed already, no text to parse
    return features.tick_features(typed, TIE, keep=TIE).select("event_id", *columns)


def _features_sql(columns: list[str]) -> str:
    shown = [c if c in ("symbol", "event_ts") else f"{q6(c)} AS {c}" for c in columns]
    return f"WITH {ME}, {features_sql('me', 'event_id')} SELECT event_id, {', '.join(shown)} FROM feat"


_NARROW = {
    "tick_features": TICK_FEATURES,
    "tick_lag_features": ["symbol", "event_ts", "price_change", "price_return", "volume_change"],
    "tick_ma5_ma20": ["symbol", "event_ts", "ma5", "ma20"],
    "tick_vwap20": ["symbol", "event_ts", "vwap"],
    "tick_price_range20": ["symbol", "event_ts", "price_range"],
    "tick_ratios": ["symbol", "event_ts", "ma5_ratio", "ma20_ratio", "vwap_ratio", "price_range_ratio"],
}
for _name, _columns in _NARROW.items():
    query(_name, _features_sql(_columns))(lambda t, columns=_columns: _features(t, columns))


def _trade_columns_sql() -> str:
    shown = ", ".join(f"{q6(c)} AS {c}" for c in TICK_DERIVED)
    order = ", ".join(TRADE_TIE)
    return f"""WITH {TRADES}, {features_sql('tt', order)} SELECT symbol, event_ts, l_orderkey, l_linenumber, l_partkey,
      l_suppkey, {shown} FROM feat"""


@query("trade_tick_features", _trade_columns_sql())
def trade_tick_features(t: Tables) -> DataFrame:
    """Three symbols share all rows and whole days share one time: ties and skew."""
    rows = features.tick_features(t.trade_ticks(), TRADE_TIE, keep=TRADE_TIE)
    return rows.select("symbol", "event_ts", *TRADE_TIE[:4], *TICK_DERIVED)


# --- time windows ---------------------------------------------------------------------------------

_BARS = f"""bars AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS s, symbol,
         arg_min(price, (event_ts, event_id)) AS first_price, arg_max(price, (event_ts, event_id)) AS last_price,
         avg(price) AS avg_price, max(price) AS max_price, min(price) AS min_price,
         arg_min(volume, (event_ts, event_id)) AS first_volume, arg_max(volume, (event_ts, event_id)) AS last_volume,
         sum(volume) AS volume_sum,
         CASE WHEN sum(volume) <> 0 THEN sum(price * volume) / sum(volume) END AS vwap,
         sum(price) AS ps, count(*) AS n
  FROM me WHERE {VALID} GROUP BY 1, 2)"""
_BAR_SHOWN = ", ".join(f"{q6(c)} AS {c}" for c in time_windows.BASE_COLUMNS)
_WINDOW_SHOWN = "s AS window_start, s + INTERVAL 1 MINUTE AS window_end, symbol"


@query("ohlcv_tumbling", f"WITH {ME}, {_BARS} SELECT {_WINDOW_SHOWN}, {_BAR_SHOWN} FROM bars")
def ohlcv_tumbling(t: Tables) -> DataFrame:
    return time_windows.ohlcv_bars(t.market_events(), "1 minute", TIE)


def _sliding_sql(minutes: int) -> str:
    return f"""WITH {ME} SELECT s AS window_start, s + INTERVAL {minutes} MINUTE AS window_end, symbol,
      {q6('avg(price)')} AS mean_price
    FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL 1 MINUTE, event_ts) - INTERVAL {minutes - 1} MINUTE,
             time_bucket(INTERVAL 1 MINUTE, event_ts), INTERVAL 1 MINUTE)) AS s FROM me WHERE {VALID})
    GROUP BY s, symbol"""


@query("sliding_ma_5m", _sliding_sql(5))
def sliding_ma_5m(t: Tables) -> DataFrame:
    return time_windows.sliding_mean(t.market_events(), "5 minutes")


@query("sliding_ma_20m", _sliding_sql(20))
def sliding_ma_20m(t: Tables) -> DataFrame:
    return time_windows.sliding_mean(t.market_events(), "20 minutes")


def _time_window_sql() -> str:
    ratios = ", ".join(
        f"{q6(f'CASE WHEN last_price > 0 THEN {c} / last_price END')} AS {c}_ratio" for c in ("ma5", "ma20", "vwap", "price_range")
    )
    return f"""WITH {ME}, {_BARS}, win AS (
      SELECT *, max_price - min_price AS price_range,
        sum(ps) OVER (PARTITION BY symbol ORDER BY s RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW)
          / sum(n) OVER (PARTITION BY symbol ORDER BY s RANGE BETWEEN INTERVAL 4 MINUTE PRECEDING AND CURRENT ROW) AS ma5,
        sum(ps) OVER (PARTITION BY symbol ORDER BY s RANGE BETWEEN INTERVAL 19 MINUTE PRECEDING AND CURRENT ROW)
          / sum(n) OVER (PARTITION BY symbol ORDER BY s RANGE BETWEEN INTERVAL 19 MINUTE PRECEDING AND CURRENT ROW) AS ma20
      FROM bars)
    SELECT {_WINDOW_SHOWN}, {_BAR_SHOWN}, {q6('ma5')} AS ma5, {q6('ma20')} AS ma20,
      {q6('last_price - first_price')} AS price_change,
      {q6('CASE WHEN first_price > 0 THEN (last_price - first_price) / first_price END')} AS price_return,
      {q6('last_volume - first_volume')} AS volume_change, {q6('price_range')} AS price_range, {ratios} FROM win"""


@query("time_window_features", _time_window_sql())
def time_window_features(t: Tables) -> DataFrame:
    return time_windows.time_window_features(t.market_events(), "1 minute", TIE)


# --- lake -----------------------------------------------------------------------------------------


@query(
    "date_partitions",
    f"""WITH {ME} SELECT event_id, symbol, CAST(year(event_ts) AS BIGINT) AS year, CAST(month(event_ts) AS BIGINT) AS month,
    CAST(day(event_ts) AS BIGINT) AS day FROM me""",
)
def date_partitions(t: Tables) -> DataFrame:
    return lake.with_date_partitions(t.market_events()).select("event_id", "symbol", "year", "month", "day")


@query(
    "retention_candidates",
    f"""WITH {ME} SELECT DISTINCT CAST(event_ts AS DATE) AS partition_date FROM me
    WHERE CAST(event_ts AS DATE) < (SELECT CAST(max(event_ts) AS DATE) - 10 FROM me)""",
)
def retention_candidates(t: Tables) -> DataFrame:
    ticks = lake.with_date_partitions(t.market_events())
    newest = t.market_events().agg(F.max("event_ts").cast("date")).scalar()
    return lake.retention_candidates(ticks, newest, 10)


@query(
    "reference_sample",
    f"""WITH {CALM}, {features_sql('calm', 'event_id')}
    SELECT {", ".join(f"{q6(c)} AS {c}" for c in MODEL_FEATURES)} FROM feat
    WHERE CAST('0x' || substr(md5('42|' || symbol || '|' || CAST(epoch_us(event_ts) AS VARCHAR)), 1, 8) AS BIGINT) % 1000000 < 100000""",
)
def reference_sample(t: Tables) -> DataFrame:
    return drift.reference_sample(features.tick_features(t.calm_events(), TIE))


