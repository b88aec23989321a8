"""Schemas of the raw frame, bronze, silver and gold layers."""

from pyspark.sql import types as T

# Raw exchange frame (bare, or wrapped as {"stream": ..., "data": {...}}).
# Single-letter keys are case sensitive ("t" trade id, "T" trade time), so
# frames are parsed into a string map, not into a struct.
RAW_REQUIRED_KEYS = ["e", "s", "t", "p", "q", "T", "m"]

BRONZE_COLUMNS = [
    "event_type", "symbol", "trade_id", "price", "quantity", "volume_usd",
    "side", "is_buyer", "timestamp", "ingested_at",
]

BRONZE_SCHEMA = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("volume_usd", T.DoubleType()),
    T.StructField("side", T.StringType()),
    T.StructField("is_buyer", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),       # Unix ms
    T.StructField("ingested_at", T.StringType()),   # ISO-8601 UTC text
])

# Hive directory keys of the bronze layout, in directory order.  Date parts
# stay text ("01") so the directory names round-trip unchanged.
BRONZE_PARTITIONS = ["symbol", "year", "month", "day"]

BRONZE_READ_SCHEMA = T.StructType(
    [f for f in BRONZE_SCHEMA.fields if f.name != "symbol"]
    + [T.StructField("symbol", T.StringType()),
       T.StructField("year", T.StringType()),
       T.StructField("month", T.StringType()),
       T.StructField("day", T.StringType())]
)

STG_TRADES_COLUMNS = [
    "trade_id", "symbol", "price", "quantity", "volume_usd", "side",
    "is_buyer", "traded_at", "timestamp_ms", "ingested_at",
]

# Clean trades as the streams write them.
STG_READ_SCHEMA = T.StructType(
    [T.StructField("trade_id", T.LongType()), T.StructField("symbol", T.StringType()), T.StructField("price", T.DoubleType()),
     T.StructField("quantity", T.DoubleType()), T.StructField("volume_usd", T.DoubleType()),
     T.StructField("side", T.StringType()), T.StructField("is_buyer", T.BooleanType()),
     T.StructField("traded_at", T.TimestampType()), T.StructField("timestamp_ms", T.LongType()),
     T.StructField("ingested_at", T.TimestampType())])

OHLCV_COLUMNS = [
    "symbol", "candle_time", "open", "high", "low", "close", "volume",
    "volume_usd", "trade_count", "buy_count", "sell_count", "buy_volume",
    "sell_volume", "volume_delta", "vwap",
]

MART_VWAP_COLUMNS = [
    "symbol", "candle_time", "close", "vwap_30min", "vwap_60min",
    "price_vs_vwap", "hourly_vwap", "hourly_high", "hourly_low",
    "hourly_volume_usd", "hourly_trade_count",
]

MART_VOLATILITY_COLUMNS = [
    "symbol", "candle_time", "close", "sma_20", "bb_upper", "bb_lower",
    "std_20", "bb_bandwidth", "realized_vol_pct", "annualized_vol", "atr_14",
    "pct_b", "log_return",
]

MART_WHALE_COLUMNS = [
    "trade_id", "symbol", "traded_at", "hour", "price", "quantity",
    "volume_usd", "side", "whale_tier", "pct_of_hour_volume", "rank_in_hour",
    "hour_whale_count", "hour_whale_volume", "hour_net_pressure",
    "hour_mega_count",
]

# Candles as the incremental refresh keeps them, in (symbol, day) directories.
CANDLES_READ_SCHEMA = T.StructType(
    [T.StructField(c, T.TimestampType() if c == "candle_time" else T.StringType() if c == "symbol"
                   else T.LongType() if c.endswith("_count") else T.DoubleType()) for c in OHLCV_COLUMNS]
    + [T.StructField("day", T.StringType())]
)
