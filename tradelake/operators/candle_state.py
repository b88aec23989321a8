"""Candles as mergeable state: stored partial aggregates instead of trades.

A state row holds what a candle needs exactly -- the order keys of its first and
last trade, exact decimal sums, counts -- so two states of the same candle merge in
any order and any grouping, and finished candles equal those from all trades.  A
batch adds its own states to the stored ones without reading old trades again, and
all widths come from one scan of the states: ``Expand`` writes each row once for
every width and one hash aggregate with a map-side step takes them together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions import BUY, SELL, order_key, round_half_away, safe_div, time_bucket
from tradelake.functions.numeric import as_decimal
from tradelake.operators.candles import QTY_SCALE, USD_SCALE, notional
from tradelake.schema import OHLCV_COLUMNS

SUMS = ("quantity", "usd", "bought", "sold", "delta", "notional", "trade_count", "buy_count", "sell_count")
WIDTHS = ("1 minute", "15 minutes", "1 hour", "1 day")


def candle_states(trades: DataFrame, interval: str = "1 minute") -> DataFrame:
    """One state row per (symbol, bucket) of deduplicated trades."""
    p, q, u, s = (F.col(c) for c in ("price", "quantity", "volume_usd", "side"))
    key = order_key(F.col("traded_at"), F.col("trade_id"))
    buy, sell = s == F.lit(BUY), s == F.lit(SELL)
    qty = lambda c: F.sum(as_decimal(c, QTY_SCALE))
    return trades.groupBy("symbol", time_bucket(F.col("traded_at"), interval).alias("candle_time")).agg(
        F.min(key).alias("open_key"), F.min_by(p, key).alias("open"),
        F.max(key).alias("close_key"), F.max_by(p, key).alias("close"),
        F.max(p).alias("high"), F.min(p).alias("low"),
        qty(q).alias("quantity"), F.sum(as_decimal(u, USD_SCALE)).alias("usd"),
        qty(F.when(buy, q)).alias("bought"), qty(F.when(sell, q)).alias("sold"), qty(F.when(buy, q).otherwise(-q)).alias("delta"),
        F.sum(notional(p, q)).alias("notional"), F.count(F.lit(1)).alias("trade_count"),
        F.count_if(buy).alias("buy_count"), F.count_if(sell).alias("sell_count"))


def merge_aggs(states: DataFrame) -> list[Column]:
    return [F.min("open_key").alias("open_key"), F.min_by("open", "open_key").alias("open"),
            F.max("close_key").alias("close_key"), F.max_by("close", "close_key").alias("close"),
            F.max("high").alias("high"), F.min("low").alias("low"),
            *[F.sum(c).cast(states.schema[c].dataType).alias(c) for c in SUMS]]


def merge_states(*parts: DataFrame) -> DataFrame:
    """States of the same width -> one row per candle."""
    states = reduce(DataFrame.unionByName, parts)
    return states.groupBy("symbol", "candle_time").agg(*merge_aggs(states))


def finished(states: DataFrame, *more: str) -> DataFrame:
    """State rows -> candles (and the columns ``more``)."""
    double = lambda c: F.col(c).cast("double")
    return states.select(
        *more, "symbol", "candle_time", "open", "high", "low", "close",
        round_half_away(double("quantity"), 8).alias("volume"), round_half_away(double("usd"), 2).alias("volume_usd"),
        "trade_count", "buy_count", "sell_count",
        round_half_away(double("bought"), 8).alias("buy_volume"), round_half_away(double("sold"), 8).alias("sell_volume"),
        round_half_away(double("delta"), 8).alias("volume_delta"),
        round_half_away(safe_div(double("notional"), double("quantity")), 6).alias("vwap")).select(*more, *OHLCV_COLUMNS)


def all_widths(states: DataFrame, widths: tuple[str, ...] = WIDTHS) -> DataFrame:
    """Candles of every width (column ``width``) from states of a width that divides
    them: one scan, one shuffle."""
    names = [f"_w{i}" for i in range(len(widths))]
    wide = states.withColumns({n: time_bucket(F.col("candle_time"), w) for n, w in zip(names, widths)})
    sets = [[F.col("symbol"), F.col(n)] for n in names]
    merged = (wide.groupingSets(sets, F.col("symbol"), *[F.col(n) for n in names])
              .agg(*merge_aggs(states), *[F.grouping(n).alias(f"{n}_out") for n in names]))
    at = [F.col(f"{n}_out") == 0 for n in names]
    pick = lambda values: reduce(lambda rest, x: F.when(x[0], x[1]).otherwise(rest), zip(at, values), F.lit(None))
    merged = merged.withColumns({"width": pick([F.lit(w) for w in widths]), "candle_time": pick([F.col(n) for n in names])})
    return finished(merged, "width")
