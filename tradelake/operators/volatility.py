"""Gold: log returns, Bollinger bands, realised volatility, ATR (mart_volatility).

All windows share one (symbol, block) partitioning and one sort; ``lag`` and
the 20-row mean / deviation are computed once and reused.  The halo is 20
rows: realised volatility at a row uses 20 log returns, which reach 20 closes
back.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions import round_half_away, safe_div
from tradelake.operators.rolling import DEFAULT_BLOCK_ROWS, rolling, running_sum
from tradelake.schema import MART_VOLATILITY_COLUMNS

# Fixed value: minutes per year used to annualise 1-minute volatility.
MINUTES_PER_YEAR = 525600


def _with_returns(r_frame: DataFrame, spec) -> DataFrame:
    prev = F.lag("close").over(spec)
    return r_frame.withColumn("_prev_close", prev).withColumns({
        "log_return": F.ln(safe_div(F.col("close"), F.col("_prev_close"))),
        "_hl": F.col("high") - F.col("low"),
        "_hpc": F.abs(F.col("high") - F.col("_prev_close")),
        "_lpc": F.abs(F.col("low") - F.col("_prev_close")),
    })


def volatility_frame(candles: DataFrame, strategy: str = "blocked",
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Every indicator column, before the mart's first-row filter."""
    r = rolling(candles, ["symbol"], "candle_time", halo=20, strategy=strategy, block_rows=block_rows)
    f = _with_returns(r.frame, r.spec)
    w20, w14 = r.spec.rowsBetween(-19, 0), r.spec.rowsBetween(-13, 0)
    f = f.withColumns({
        "_avg20": F.avg("close").over(w20),
        "_sd20": F.stddev_samp("close").over(w20),
        "_rv": F.stddev_samp("log_return").over(w20) * F.lit(100.0),
        "_atr": F.avg(F.greatest("_hl", "_hpc", "_lpc")).over(w14),
    })
    upper = F.col("_avg20") + F.lit(2.0) * F.col("_sd20")
    lower = F.col("_avg20") - F.lit(2.0) * F.col("_sd20")
    f = f.withColumns({
        "sma_20": round_half_away(F.col("_avg20"), 6),
        "std_20": round_half_away(F.col("_sd20"), 6),
        "bb_upper": round_half_away(upper, 6),
        "bb_lower": round_half_away(lower, 6),
        "realized_vol_pct": round_half_away(F.col("_rv"), 6),
        "atr_14": round_half_away(F.col("_atr"), 6),
        "bb_bandwidth": round_half_away(safe_div(upper - lower, F.col("_avg20")), 6),
    })
    f = f.withColumns({
        "annualized_vol": round_half_away(
            F.col("realized_vol_pct") * F.lit(math.sqrt(MINUTES_PER_YEAR)) / F.lit(100.0), 6),
        "pct_b": round_half_away(
            safe_div(F.col("close") - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")), 6),
    })
    return r.finish(f)


def mart_volatility(candles: DataFrame, strategy: str = "blocked") -> DataFrame:
    """One row per candle except each symbol's first (no previous close)."""
    return (volatility_frame(candles, strategy)
            .where(F.col("log_return").isNotNull())
            .select(*MART_VOLATILITY_COLUMNS))


def log_returns(candles: DataFrame, strategy: str = "blocked") -> DataFrame:
    r = rolling(candles, ["symbol"], "candle_time", halo=1, strategy=strategy)
    f = _with_returns(r.frame, r.spec)
    return r.finish(f).select("symbol", "candle_time", "close",
                              F.col("_prev_close").alias("prev_close"), "log_return",
                              F.greatest("_hl", "_hpc", "_lpc").alias("true_range"))


def cvd(candles: DataFrame) -> DataFrame:
    """Cumulative volume delta per symbol from its first candle."""
    return running_sum(candles.select("symbol", "candle_time", "volume_delta"),
                       ["symbol"], "candle_time", "volume_delta", "cvd", scale=8)
