"""Gold: whale trades with hourly market context (mart_whale_trades)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions import BUY, SELL, round_half_away, safe_div, whale_tier, xavg, xsum
from tradelake.functions.expressions import DEFAULT_WHALE_THRESHOLD
from tradelake.operators.ranking import rank_desc
from tradelake.schema import MART_WHALE_COLUMNS


def hourly_market(trades: DataFrame) -> DataFrame:
    """Totals of all trades per (symbol, hour): the context of each whale."""
    return (trades.groupBy("symbol", F.date_trunc("hour", "traded_at").alias("hour"))
            .agg(xsum("volume_usd", 6).alias("hour_total_volume_usd"),
                 F.count(F.lit(1)).alias("hour_total_trades"),
                 xavg("price", 10).alias("hour_avg_price")))


def whale_filter(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD) -> DataFrame:
    return trades.where(F.col("volume_usd") >= F.lit(float(threshold)))


def whale_base(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD) -> DataFrame:
    """Whales with their hour and tier (no cross-row context)."""
    return (whale_filter(trades, threshold)
            .withColumn("hour", F.date_trunc("hour", "traded_at"))
            .withColumn("whale_tier", whale_tier(F.col("volume_usd"))))


def hourly_context(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD) -> DataFrame:
    """Per (symbol, hour): the totals of all trades and of its whales, in one
    aggregate.  Write it before joining: a join to a written table is one that
    AQE can split where an hour holds very many whales."""
    return (trades.groupBy("symbol", F.date_trunc("hour", "traded_at").alias("hour"))
            .agg(*context_aggs(threshold))
            .where(F.col("hour_whale_count") > 0))


def context_aggs(threshold: float = DEFAULT_WHALE_THRESHOLD) -> list[Column]:
    """The measures of an hour: all its trades, and its whales."""
    v, s = F.col("volume_usd"), F.col("side")
    big = v >= F.lit(float(threshold))
    return [xsum("volume_usd", 6).alias("hour_total_volume_usd"),
            F.count(F.lit(1)).alias("hour_total_trades"),
            F.count_if(big).alias("hour_whale_count"),
            round_half_away(xsum(F.when(big, v), 6), 2).alias("hour_whale_volume"),
            round_half_away(xsum(F.when(big & (s == F.lit(BUY)), v).when(big, -v), 6), 2).alias("hour_net_pressure"),
            F.count_if(big & (whale_tier(v) == F.lit("mega"))).alias("hour_mega_count")]


def with_hour(whales: DataFrame, context: DataFrame) -> DataFrame:
    """Whales beside their hour: one join for all measures of the hour."""
    return share_of_hour(whales.join(context, ["symbol", "hour"], "left"))


def share_of_hour(whales: DataFrame) -> DataFrame:
    return whales.withColumn("pct_of_hour_volume", round_half_away(
        safe_div(F.col("volume_usd"), F.col("hour_total_volume_usd")) * F.lit(100.0), 4))


def whale_trades(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD,
                 rank_strategy: str = "split", context: DataFrame | None = None) -> DataFrame:
    """Whales with share of hour volume, tier, rank among the hour's whales and
    the hour's whale measures.

    The threshold filter runs before the rank (rank is among whales only) and
    on the left side of the join only: hour totals cover all trades.
    """
    ranked = rank_desc(whale_base(trades, threshold), ["symbol", "hour"], "volume_usd",
                       "rank_in_hour", rank_strategy)
    return with_hour(ranked, hourly_context(trades, threshold) if context is None else context)


def hourly_whale_summary(whales: DataFrame) -> DataFrame:
    v, s, t = F.col("volume_usd"), F.col("side"), F.col("whale_tier")
    return (whales.groupBy("symbol", "hour").agg(
        F.count(F.lit(1)).alias("whale_trade_count"),
        round_half_away(xsum(v, 6), 2).alias("whale_volume_usd"),
        round_half_away(xavg(v, 6), 2).alias("avg_whale_size_usd"),
        round_half_away(F.max(v), 2).alias("max_whale_size_usd"),
        round_half_away(xsum(F.when(s == F.lit(BUY), v).otherwise(-v), 6), 2).alias("whale_net_pressure"),
        F.count_if(s == F.lit(BUY)).alias("whale_buys"),
        F.count_if(s == F.lit(SELL)).alias("whale_sells"),
        F.count_if(t == F.lit("mega")).alias("mega_trades"),
        F.count_if(t == F.lit("large")).alias("large_trades"),
        F.count_if(t == F.lit("medium")).alias("medium_trades"),
        F.count_if(t == F.lit("small")).alias("small_trades"),
    ))


def mart_whale_trades(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD,
                      rank_strategy: str = "split", context: DataFrame | None = None) -> DataFrame:
    """Each whale with its hour.  ``context``: ``hourly_context`` of the same
    trades, if it is written already."""
    return whale_trades(trades, threshold, rank_strategy, context).select(*MART_WHALE_COLUMNS)
