"""Serving queries behind the dashboard and notebook panels.

Each is a bounded read of a silver or gold table: a per-symbol filter that
reaches the scan, a ``orderBy(...).limit(n)`` that plans as
TakeOrderedAndProject (top-k per task, then a merge of k rows per task), or
an aggregate with a map-side partial step.  Every limit carries a total
order, so the rows kept at the cut are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.functions import (BUY, SIDES, TIER_ORDER, clip_negative, clip_positive,
                                 round_half_away, safe_div, xavg, xsum)
from tradelake.functions.expressions import DEFAULT_WHALE_THRESHOLD


def overview(stg: DataFrame) -> DataFrame:
    """Per-symbol trade statistics, largest USD volume first."""
    return (stg.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_trades"),
        round_half_away(F.min("price"), 2).alias("price_min"),
        round_half_away(F.max("price"), 2).alias("price_max"),
        round_half_away(xavg("price", 10), 2).alias("price_avg"),
        round_half_away(xsum("volume_usd", 6) / F.lit(1e6), 2).alias("total_volume_m"),
        F.min("traded_at").alias("first_trade"),
        F.max("traded_at").alias("last_trade"),
    ).orderBy(F.col("total_volume_m").desc(), F.col("symbol")))


def kpi(candles: DataFrame, symbol: str | None = None, hours: int | None = None) -> DataFrame:
    """KPI row per symbol: last/first close, range, USD volume, last VWAP.

    Spans all history unless ``hours`` is given (then the last ``hours`` before
    each symbol's newest candle).
    """
    c = candles if symbol is None else candles.where(F.col("symbol") == F.lit(symbol))
    if hours is not None:
        newest = c.groupBy("symbol").agg(F.max("candle_time").alias("_newest"))
        c = (c.join(newest, "symbol")
             .where(F.col("candle_time") > F.col("_newest") - F.expr(f"INTERVAL {int(hours)} HOURS"))
             .drop("_newest"))
    k = (c.groupBy("symbol").agg(
        F.max_by("close", "candle_time").alias("last_price"),
        F.min_by("close", "candle_time").alias("first_price"),
        F.max("high").alias("high_24h"),
        F.min("low").alias("low_24h"),
        round_half_away(xsum("volume_usd", 2) / F.lit(1e6), 2).alias("volume_m"),
        F.max_by("vwap", "candle_time").alias("last_vwap")))
    return k.withColumn("pct_change", safe_div(F.col("last_price") - F.col("first_price"),
                                               F.col("first_price")) * F.lit(100.0))


def last_n(df: DataFrame, symbol: str, n: int, order_col: str = "candle_time") -> DataFrame:
    """The newest ``n`` rows of one symbol (filter reaches the scan)."""
    return df.where(F.col("symbol") == F.lit(symbol)).orderBy(F.col(order_col).desc()).limit(n)


def last_candles(candles: DataFrame, symbol: str, n: int = 120) -> DataFrame:
    cols = ["candle_time", "open", "high", "low", "close", "volume_usd", "vwap",
            "volume_delta", "buy_volume", "sell_volume"]
    return (last_n(candles, symbol, n).select(*cols, (F.col("close") >= F.col("open")).alias("is_bull"))
            .orderBy("candle_time"))


def candle_shape(candles: DataFrame) -> DataFrame:
    """Bull/bear flag, body height and body base of every candle."""
    return candles.select(
        "symbol", "candle_time",
        (F.col("close") >= F.col("open")).alias("is_bull"),
        F.abs(F.col("close") - F.col("open")).alias("body"),
        F.least("open", "close").alias("body_base"))


def bollinger_panel(mart_vol: DataFrame, symbol: str, n: int = 120) -> DataFrame:
    return (last_n(mart_vol, symbol, n)
            .select("candle_time", "close", "sma_20", "bb_upper", "bb_lower", "pct_b",
                    "realized_vol_pct", "bb_bandwidth").orderBy("candle_time"))


def vwap_deviation_split(mart_vwap: DataFrame, symbol: str, n: int = 120) -> DataFrame:
    """Price-vs-VWAP split into its positive and negative parts (NULL kept)."""
    pvv = F.col("price_vs_vwap")
    return (last_n(mart_vwap, symbol, n)
            .select("candle_time", "close", "vwap_30min", "vwap_60min", "price_vs_vwap",
                    "hourly_vwap", clip_positive(pvv).alias("above_vwap"),
                    clip_negative(pvv).alias("below_vwap"))
            .orderBy("candle_time"))


def vwap_last30(mart_vwap: DataFrame, symbol: str) -> DataFrame:
    return last_n(mart_vwap, symbol, 30).select("candle_time", "vwap_30min", "close")


def recent_order() -> list:
    """Newest first; symbol and id make the order total (ids repeat across symbols)."""
    return [F.col("traded_at").desc(), F.col("symbol").asc(), F.col("trade_id").asc()]


def whales_recent(mart_whale: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD,
                  n: int = 100) -> DataFrame:
    """Newest whales at or above a (client-side) threshold."""
    return (mart_whale.where(F.col("volume_usd") >= F.lit(float(threshold)))
            .orderBy(*recent_order()).limit(n)
            .select("traded_at", "symbol", "trade_id", "price", "volume_usd", "side",
                    "whale_tier", "pct_of_hour_volume", "rank_in_hour"))


def top_whales(mart_whale: DataFrame, k: int = 5) -> DataFrame:
    return (mart_whale.orderBy(F.col("volume_usd").desc(), *recent_order()).limit(k)
            .select("symbol", "traded_at", "price", "volume_usd", "side"))


def recent_whales(mart_whale: DataFrame, n: int = 200) -> DataFrame:
    return mart_whale.orderBy(*recent_order()).limit(n)


def top10_recent_whales(mart_whale: DataFrame, n: int = 200, k: int = 10) -> DataFrame:
    """Largest ``k`` among the newest ``n`` (ties keep the newer trade)."""
    return (recent_whales(mart_whale, n).orderBy(F.col("volume_usd").desc(), *recent_order()).limit(k)
            .select("traded_at", "symbol", "trade_id", "price", "volume_usd", "side",
                    "whale_tier", "pct_of_hour_volume"))


def whale_tier_crosstab(spark: SparkSession, mart_whale: DataFrame, n: int = 200) -> DataFrame:
    """Tier x side counts of the newest ``n`` whales; all four tiers, zero-filled."""
    counts = (recent_whales(mart_whale, n).groupBy("whale_tier")
              .agg(*[F.count_if(F.col("side") == F.lit(s)).alias(s) for s in SIDES]))
    tiers = spark.createDataFrame([(t, i) for i, t in enumerate(TIER_ORDER)], "whale_tier string, tier_order int")
    return (tiers.join(counts, "whale_tier", "left").na.fill(0, subset=SIDES)
            .select("whale_tier", "tier_order", *SIDES).orderBy("tier_order"))


def vol_compare(mart_vol: DataFrame, n: int = 360) -> DataFrame:
    """Newest ``n`` rows over all symbols (not per symbol)."""
    return (mart_vol.orderBy(F.col("candle_time").desc(), F.col("symbol").asc()).limit(n)
            .select("symbol", "candle_time", "realized_vol_pct", "annualized_vol", "close")
            .orderBy("symbol", "candle_time"))


def normalized_price(mart_vol: DataFrame, n: int = 360) -> DataFrame:
    """Close relative to each symbol's first close inside the newest ``n`` rows (=100)."""
    w = Window.partitionBy("symbol").orderBy("candle_time")
    return (vol_compare(mart_vol, n)
            .withColumn("normalized_price", F.col("close") / F.first("close").over(w) * F.lit(100.0))
            .select("symbol", "candle_time", "close", "normalized_price"))


def vol_compare_per_symbol(mart_vol: DataFrame, k: int = 120) -> DataFrame:
    """Newest ``k`` rows of every symbol; the row_number filter is planned as a
    WindowGroupLimit, so each task keeps k rows per symbol before the shuffle."""
    w = Window.partitionBy("symbol").orderBy(F.col("candle_time").desc())
    return (mart_vol.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
            .select("symbol", "candle_time", "realized_vol_pct", "annualized_vol", "close"))


def buy_pressure(stg: DataFrame) -> DataFrame:
    """Share of USD volume bought, per (symbol, hour), in percent, 1 decimal."""
    v = F.col("volume_usd")
    return (stg.groupBy("symbol", F.date_trunc("hour", "traded_at").alias("hour"))
            .agg(round_half_away(safe_div(xsum(F.when(F.col("side") == F.lit(BUY), v), 6),
                                          xsum(v, 6)) * F.lit(100.0), 1).alias("buy_pct")))


def buy_pressure_pivot(stg: DataFrame, symbols: list[str]) -> DataFrame:
    """One row per hour, one column per symbol.

    The panel this serves draws symbols as rows and hours as columns; hours
    grow without bound, so the scalable frame keeps hours as rows and the
    (known, small) symbol list as columns.  Values are passed, so no extra
    job discovers them; a symbol that is not among them is an error, not a
    column that silently lacks.  ``buy_pressure`` has any number of symbols.
    """
    listed = F.when(F.col("symbol").isin(*symbols), F.col("symbol")).otherwise(
        F.raise_error(F.concat(F.lit("symbol without a column: "), F.coalesce("symbol", F.lit("null")))))
    return (buy_pressure(stg).withColumn("symbol", listed).groupBy("hour").pivot("symbol", symbols)
            .agg(F.first("buy_pct"))
            .withColumn("hour_label", F.date_format("hour", "HH:mm")))   # display only; repeats daily


def hourly_volatility(mart_vol: DataFrame) -> DataFrame:
    """Mean realised / annualised volatility per (symbol, hour)."""
    return (mart_vol.groupBy("symbol", F.date_trunc("hour", "candle_time").alias("hour"))
            .agg(round_half_away(xavg("realized_vol_pct", 6), 6).alias("volatility_pct"),
                 round_half_away(xavg("annualized_vol", 6), 6).alias("annualized_vol_pct")))


def pct_b_signal(mart_vol: DataFrame) -> DataFrame:
    """%B above 1: overbought; below 0: oversold; otherwise neutral."""
    b = F.col("pct_b")
    sig = (F.when(b > 1, F.lit("overbought")).when(b < 0, F.lit("oversold"))
           .when(b.isNotNull(), F.lit("neutral")))
    return mart_vol.select("symbol", "candle_time", "close", "pct_b", sig.alias("signal"))
