"""Gold: hourly VWAP, rolling 30/60-candle VWAP and their join (mart_vwap)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.functions import as_decimal, round_half_away, safe_div, xsum, xsum_over
from tradelake.operators.rolling import DEFAULT_BLOCK_ROWS, rolling
from tradelake.schema import MART_VWAP_COLUMNS


def hourly_vwap(candles: DataFrame) -> DataFrame:
    """Roll 1-minute candles up to (symbol, hour); VWAP from the rounded sums."""
    return (candles.groupBy("symbol", F.date_trunc("hour", "candle_time").alias("hour"))
            .agg(round_half_away(safe_div(xsum("volume_usd", 2), xsum("volume", 8)), 6).alias("vwap"),
                 round_half_away(xsum("volume_usd", 2), 2).alias("total_volume_usd"),
                 round_half_away(xsum("volume", 8), 8).alias("total_volume"),
                 F.sum("trade_count").cast("long").alias("trade_count"),
                 F.max("high").alias("high"),
                 F.min("low").alias("low"),
                 F.min_by("open", "candle_time").alias("open"),
                 F.max_by("close", "candle_time").alias("close"),
                 round_half_away(F.max("high") - F.min("low"), 6).alias("price_range")))


def trailing_sums(frame: DataFrame, spec, cols: dict[str, int], widths: list[int]) -> DataFrame:
    """Exact sums over the last ``w`` rows as differences of running sums.

    A sliding ``rowsBetween(-w+1, 0)`` frame re-adds the whole frame for every
    row (O(n*w)); a running decimal sum is O(n), and ``cum - lag(cum, w)`` is
    the same exact total.  Columns ``_cum_<c>`` and ``_sum<w>_<c>`` (double)
    are added.
    """
    running = spec.rowsBetween(Window.unboundedPreceding, 0)
    f = frame.withColumns({f"_cum_{c}": F.sum(as_decimal(c, scale)).over(running)
                           for c, scale in cols.items()})
    zero = {c: F.lit(0).cast(f"decimal(38,{scale})") for c, scale in cols.items()}
    return f.withColumns({
        f"_sum{w}_{c}": (F.col(f"_cum_{c}") - F.coalesce(F.lag(f"_cum_{c}", w).over(spec), zero[c])).cast("double")
        for c in cols for w in widths})


def rolling_vwap(candles: DataFrame, strategy: str = "blocked",
                 block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """VWAP over the last 30 and 60 candles (row frames: gaps are not filled)."""
    r = rolling(candles, ["symbol"], "candle_time", halo=59, strategy=strategy, block_rows=block_rows)
    # Candle USD volumes carry 2 decimals and volumes 8: exact trailing sums.
    f = trailing_sums(r.frame, r.spec, {"volume_usd": 2, "volume": 8}, [30, 60])
    v30 = safe_div(F.col("_sum30_volume_usd"), F.col("_sum30_volume"))
    v60 = safe_div(F.col("_sum60_volume_usd"), F.col("_sum60_volume"))
    out = f.select(
        "*",
        round_half_away(v30, 6).alias("vwap_30min"),
        round_half_away(v60, 6).alias("vwap_60min"),
        round_half_away(F.col("close") - v30, 6).alias("price_vs_vwap"),
    )
    return r.finish(out).select("symbol", "candle_time", "close", "volume", "volume_usd",
                                "vwap_30min", "vwap_60min", "price_vs_vwap")


def rolling_vwap_range(candles: DataFrame, minutes: int = 30) -> DataFrame:
    """Time-range variant: candles whose time is within the last ``minutes``.

    Unlike the row frame, a gap shortens the window.  The frame reaches a
    bounded time span back, so the per-symbol partition is cut by day with the
    previous ``minutes`` of the prior day copied in (same halo idea, in time).
    """
    span_us = (minutes - 1) * 60 * 1_000_000
    day = F.date_trunc("day", "candle_time")
    starts_near_midnight = F.unix_micros("candle_time") - F.unix_micros(day) >= F.lit(86_400_000_000 - span_us)
    copies = F.when(starts_near_midnight, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    framed = (candles.withColumn("_copy", F.explode(copies))
              .withColumn("_day", F.date_add(day.cast("date"), F.col("_copy")))
              .withColumn("_us", F.unix_micros("candle_time")))
    w = Window.partitionBy("symbol", "_day").orderBy("_us").rangeBetween(-span_us, 0)
    v = safe_div(xsum_over("volume_usd", 2, w), xsum_over("volume", 8, w))
    out = framed.select("symbol", "candle_time", "close", "_copy",
                        round_half_away(v, 6).alias(f"vwap_{minutes}min_range"))
    return out.where(F.col("_copy") == 0).drop("_copy")


def mart_vwap(candles: DataFrame, strategy: str = "blocked") -> DataFrame:
    """Rolling VWAP per candle, left-joined to the candle's hourly VWAP.

    The right side is grouped by exactly the join key, so no left row is lost
    or repeated.  It holds one row per (symbol, hour); AQE broadcasts it when
    the measured size allows, and sort-merges (skew-split) otherwise.
    """
    h = hourly_vwap(candles).select(
        "symbol", "hour",
        F.col("vwap").alias("hourly_vwap"), F.col("high").alias("hourly_high"),
        F.col("low").alias("hourly_low"), F.col("total_volume_usd").alias("hourly_volume_usd"),
        F.col("trade_count").alias("hourly_trade_count"))
    r = rolling_vwap(candles, strategy).withColumn("hour", F.date_trunc("hour", "candle_time"))
    return r.join(h, ["symbol", "hour"], "left").select(*MART_VWAP_COLUMNS)
