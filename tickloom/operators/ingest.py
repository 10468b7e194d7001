"""From raw exchange payloads to validated market events. Works on tables and on streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import epoch_millis_to_iso, is_non_negative, is_positive
from tickloom.operators.ordered import first_rows
from tickloom.schemas import MARKET_EVENT

EVENT_FIELDS = ["symbol", "price", "volume", "timestamp"]
REJECT = "reject_reason"

# Numbers arrive as JSON strings or numbers, so every leaf is read as text and cast afterwards.
_NORMAL = "symbol string, price string, volume string, timestamp string"
FLAT_TRADE = f"{_NORMAL}, s string, p string, q string, T string"
NESTED_TRADE = f"{_NORMAL}, data array<struct<s: string, p: string, v: string, t: string>>"
# Message fields above, symbol prefix of the nested form.
SYMBOL_PREFIX = "BINANCE:"


def parse_ticks_json(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Decode JSON market events from a text or binary column; bad JSON becomes a row of NULLs."""
    parsed = F.from_json(F.col(value).cast("string"), MARKET_EVENT).alias("data")
    return df.select(*(keep or []), parsed).select(*(keep or []), "data.*")


def decode_events(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Decode JSON market events and keep every message: its ``payload`` as text and, where it is no good event, why.

    ``accepted`` gives the events, ``rejected`` what goes to the dead letters.
    """
    text = F.col(value).cast("string")
    parsed = df.select(*(keep or []), text.alias("payload"), F.from_json(text, MARKET_EVENT).alias("data"))
    rows = parsed.select(*(keep or []), "payload", "data.*")
    broken = F.when(F.json_object_keys("payload").isNull(), "not a JSON object")
    price, volume = F.col("price"), F.col("volume")
    unreadable = F.when(F.try_to_timestamp("timestamp").isNull(), "unreadable timestamp")
    return rows.withColumn(REJECT, F.coalesce(broken, _reason(price, volume), unreadable))


def to_messages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Key/value rows for a message log: keyed by symbol, the event as JSON text."""
    return df.select(
        F.col("symbol").alias("key"), F.to_json(F.struct(*(columns or MARKET_EVENT.names))).alias("value")
    )


def _adapted(df: DataFrame, payload: str, body: Column, trade: dict[str, Column]) -> DataFrame:
    """Add the event fields and, where that fails, the reason why."""
    normal = {f: body[f] for f in EVENT_FIELDS}
    is_normal = normal["symbol"].isNotNull()
    for field in EVENT_FIELDS[1:]:
        is_normal &= normal[field].isNotNull()
    text = {f: F.when(is_normal, normal[f]).otherwise(trade[f]) for f in EVENT_FIELDS}
    price, volume = text["price"].try_cast("double"), text["volume"].try_cast("double")
    time_given = is_normal | trade["millis"].isNotNull()
    missing = (
        text["symbol"].isNull() | ((text["symbol"] == "") & ~is_normal) | text["price"].isNull()
        | text["volume"].isNull() | ~time_given
    )
    reason = (
        F.when(missing & F.json_object_keys(payload).isNull(), "not a JSON object")
        .when(missing, "missing trade fields")
        .when(price.isNull() | volume.isNull() | text["timestamp"].isNull(), "not a number")
    )
    return df.withColumns(
        {
            "symbol": text["symbol"],
            "price": price,
            "volume": volume,
            "timestamp": text["timestamp"],
            REJECT: reason,
        }
    )


def _trade(symbol: Column, price: Column, volume: Column, millis: Column) -> dict[str, Column]:
    iso = epoch_millis_to_iso(millis.try_cast("bigint"))
    return {"symbol": symbol, "price": price, "volume": volume, "timestamp": iso, "millis": millis}


def adapt_flat_trades(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Exchange A: one trade per message, fields ``s, p, q, T`` at the top level."""
    body = F.col("_body")
    parsed = df.withColumn("_body", F.from_json(payload, FLAT_TRADE))
    return _adapted(parsed, payload, body, _trade(body["s"], body["p"], body["q"], body["T"])).drop("_body")


def adapt_nested_trades(df: DataFrame, payload: str = "payload", explode_all: bool = False) -> DataFrame:
    """Exchange B: trades in an array ``data``. Only the first one counts unless ``explode_all``."""
    body, trade = F.col("_body"), F.col("_trade")
    parsed = df.withColumn("_body", F.from_json(payload, NESTED_TRADE))
    parsed = parsed.withColumn("_trade", F.explode_outer("_body.data") if explode_all else F.get("_body.data", F.lit(0)))
    fields = _trade(F.replace(trade["s"], F.lit(SYMBOL_PREFIX), F.lit("")), trade["p"], trade["v"], trade["t"])
    return _adapted(parsed, payload, body, fields).drop("_body", "_trade")


def adapt_trades(df: DataFrame, source: str = "source", payload: str = "payload") -> DataFrame:
    """Adapt each message by its source; an unknown source must send normalized events already."""
    flat, nested = F.col("_flat"), F.col("_nested")
    parsed = df.withColumns(
        {
            "_flat": F.when(F.col(source).isNull() | (F.col(source) != "finnhub"), F.from_json(payload, FLAT_TRADE)),
            "_nested": F.when(F.col(source) == "finnhub", F.from_json(payload, NESTED_TRADE)),
        }
    )
    first = F.get(nested["data"], F.lit(0))
    is_flat, is_nested = F.col(source) == "binance", F.col(source) == "finnhub"

    def pick(a: Column, b: Column) -> Column:
        return F.when(is_flat, a).when(is_nested, b)

    body = F.struct(*[F.coalesce(flat[f], nested[f]).alias(f) for f in EVENT_FIELDS])
    trade = _trade(
        pick(flat["s"], F.replace(first["s"], F.lit(SYMBOL_PREFIX), F.lit(""))),
        pick(flat["p"], first["p"]),
        pick(flat["q"], first["v"]),
        pick(flat["T"], first["t"]),
    )
    parsed = parsed.withColumn("_body", body)
    return _adapted(parsed, payload, F.col("_body"), trade).drop("_body", "_flat", "_nested")


def _reason(price: Column, volume: Column) -> Column:
    """Why the four event fields are no event; ``price`` and ``volume`` are those fields as numbers."""
    missing = F.col("symbol").isNull() | F.col("price").isNull() | F.col("volume").isNull() | F.col("timestamp").isNull()
    return (
        F.when(missing, "missing fields")
        .when(price.isNull() | volume.isNull(), "not a number")
        .when(~is_positive(price) | ~is_non_negative(volume), "price or volume out of range")
        .when(F.col("timestamp") == "", "empty timestamp")
    )


def normalize_events(df: DataFrame, source: Column | str = "unknown") -> DataFrame:
    """Check the four event fields and add source, idempotency key and receive time.

    Rows that fail keep a ``reject_reason``; an earlier reason from adapting is kept.
    """
    source = F.lit(source) if isinstance(source, str) else source
    price, volume = F.col("price").try_cast("double"), F.col("volume").try_cast("double")
    reason = _reason(price, volume)
    earlier = F.col(REJECT) if REJECT in df.columns else F.lit(None).cast("string")
    return df.withColumns(
        {
            "symbol": F.col("symbol").cast("string"),
            "price": price,
            "volume": volume,
            "source": source,
            "idempotency_key": F.concat_ws("-", "symbol", "timestamp", source),
            "received_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            REJECT: F.coalesce(earlier, reason),
        }
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REJECT).isNull()).drop(REJECT)


def rejected(df: DataFrame) -> DataFrame:
    """Rows for the dead-letter table, with their reason."""
    return df.where(F.col(REJECT).isNotNull())


def validate_events(df: DataFrame) -> DataFrame:
    """Parse the event time and keep rows with a positive price, a volume and a time."""
    if "timestamp" in df.columns:
        df = df.withColumn("event_ts", F.try_to_timestamp("timestamp"))
    return df.where(is_positive(F.col("price")) & is_non_negative(F.col("volume")) & F.col("event_ts").isNotNull())


def validate_training_rows(df: DataFrame) -> DataFrame:
    """Range checks on raw lake rows: price, volume and a non-empty time text."""
    return df.where(
        is_positive(F.col("price"))
        & is_non_negative(F.col("volume"))
        & F.col("timestamp").isNotNull()
        & (F.col("timestamp") != "")
    )


def dedup_by_key(df: DataFrame, key: str = "idempotency_key", order: list[str] | None = None) -> DataFrame:
    """Keep the earliest row per key by parsed time, ties by ``order``.

    A group of copies of any size is cut to one row per map task before the shuffle.
    """
    earliest = F.coalesce(F.col("event_ts"), F.try_to_timestamp("timestamp")) if "event_ts" in df.columns else F.try_to_timestamp("timestamp")
    ranked = df.withColumn("_seen", earliest)
    return first_rows(ranked, [key], [F.col("_seen").asc_nulls_last(), *(order or ["timestamp"])]).drop("_seen")


def validate_training_data(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Range checks, then one row per idempotency key."""
    return dedup_by_key(validate_training_rows(df), order=order)


def dedup_stream(df: DataFrame, delay: str = "10 minutes", key: str = "idempotency_key") -> DataFrame:
    """Streaming form of the dedup: forget keys once the watermark has passed them."""
    return df.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark([key])
