"""OHLCV candles from trades, at any width.

Every aggregate here has a map-side partial step (``min_by``/``max_by`` on a
decimal key, sums, counts), so the shuffle carries at most one row per
(task, symbol, bucket): a symbol holding a third of all trades does not make
a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions import BUY, SELL, order_key, round_half_away, safe_div, time_bucket, xsum
from tradelake.schema import OHLCV_COLUMNS


# Fixed-point scales of the exact sums: quantities carry up to 10 decimals, USD
# volumes are rounded to 6 at the trade level.  Price times quantity is a
# decimal product of 8 decimals each (what exchanges quote), so that dust trades
# do not vanish.
QTY_SCALE = 10
USD_SCALE = 6


def notional(price: Column, qty: Column) -> Column:
    return price.cast("decimal(16,8)") * qty.cast("decimal(21,8)")


def candle_aggs(price="price", qty="quantity", usd="volume_usd", side="side",
                ts="traded_at", tie="trade_id") -> list[Column]:
    """The aggregate list, shared by batch and streaming candles."""
    p, q, u, s = F.col(price), F.col(qty), F.col(usd), F.col(side)
    k = order_key(F.col(ts), F.col(tie))   # open/close: earliest/latest, ties by id
    is_buy, is_sell = s == F.lit(BUY), s == F.lit(SELL)
    return [
        F.min_by(p, k).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, k).alias("close"),
        round_half_away(xsum(q, QTY_SCALE), 8).alias("volume"),
        round_half_away(xsum(u, USD_SCALE), 2).alias("volume_usd"),
        F.count(F.lit(1)).alias("trade_count"),
        F.count_if(is_buy).alias("buy_count"),
        F.count_if(is_sell).alias("sell_count"),
        round_half_away(xsum(F.when(is_buy, q), QTY_SCALE), 8).alias("buy_volume"),
        round_half_away(xsum(F.when(is_sell, q), QTY_SCALE), 8).alias("sell_volume"),
        round_half_away(xsum(F.when(is_buy, q).otherwise(-q), QTY_SCALE), 8).alias("volume_delta"),
        round_half_away(safe_div(F.sum(notional(p, q)).cast("double"), xsum(q, QTY_SCALE)), 6).alias("vwap"),
    ]


def ohlcv(trades: DataFrame, interval: str = "1 minute", bucket: Column | None = None) -> DataFrame:
    """One row per (symbol, bucket) that has trades; empty buckets have no row.

    ``bucket`` overrides the grouping column, e.g. ``window(traded_at, ...)
    .start`` on a stream.
    """
    b = bucket if bucket is not None else time_bucket(F.col("traded_at"), interval)
    return (trades.groupBy(F.col("symbol"), b.alias("candle_time"))
            .agg(*candle_aggs()).select(*OHLCV_COLUMNS))
