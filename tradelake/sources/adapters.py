"""Project the driver's test tables onto the bronze trade schema.

The test data has no market trades, so two deterministic projections stand in
for the exchange feed.  The same projections are written in the oracle SQL
(``tradelake.plans.oracle``).

* events   -> trades for candles, VWAP and volatility (5 symbols, distinct
  microsecond timestamps, a month of data);
* lineitem -> trades for dedup and whales (3 symbols, real duplicate keys,
  every whale tier occurs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import BUY, SELL, round_half_away
from tradelake.schema import BRONZE_COLUMNS
from tradelake.session import prepare


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_utc(ts) -> F.Column:
    """ISO-8601 text with microseconds and an explicit +00:00 offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def trades_from_events(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")           # NTZ in the files; UTC session
    price = F.col("value")
    qty = F.get_json_object("props", "$.k").try_cast("double")
    side = F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit(BUY)).otherwise(F.lit(SELL))
    return events.select(
        F.lit("trade").alias("event_type"),
        F.upper("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        price.alias("price"),
        qty.alias("quantity"),
        round_half_away(price * qty, 6).alias("volume_usd"),
        side.alias("side"),
        (side == F.lit(BUY)).alias("is_buyer"),
        F.unix_millis(ts).alias("timestamp"),
        iso_utc(ts).alias("ingested_at"),
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    ts = F.col("l_shipdate").cast("timestamp")
    price = F.col("l_extendedprice")
    qty = F.col("l_quantity")
    side = F.when(F.col("l_linestatus") == F.lit("O"), F.lit(BUY)).otherwise(F.lit(SELL))
    return lineitem.select(
        F.lit("trade").alias("event_type"),
        F.concat(F.lit("SYM_"), F.col("l_returnflag")).alias("symbol"),
        (F.col("l_orderkey") * F.lit(10) + F.col("l_linenumber")).cast("long").alias("trade_id"),
        price.alias("price"),
        qty.alias("quantity"),
        round_half_away(price * qty, 6).alias("volume_usd"),
        side.alias("side"),
        (side == F.lit(BUY)).alias("is_buyer"),
        F.unix_millis(ts).alias("timestamp"),
        iso_utc(ts).alias("ingested_at"),
    )


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_events(load_table(spark, sf_dir, "events")).select(*BRONZE_COLUMNS)


def lineitem_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_lineitem(load_table(spark, sf_dir, "lineitem")).select(*BRONZE_COLUMNS)


# Symbols each adapter produces (pivot columns must be known up front).
EVENT_SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
LINEITEM_SYMBOLS = ["SYM_A", "SYM_N", "SYM_R"]
