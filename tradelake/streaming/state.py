"""Keyed state on a stream: replay dedup with the batch rule, and silent symbols.

``settled_trades`` decides between the copies of a trade as the batch does, by the
least ``ingested_at``, in whatever order they arrive: the copies of a key form a
session whose state is one row, the best copy so far, and the trade is emitted once
the watermark has passed the horizon within which replays come.  Copies are
combined before the shuffle, so a trade that is replayed a million times costs one
row a task.

``silence_alerts`` keeps the last arrival of each symbol with a processing-time
timer, which fires without any new data: a symbol that is quiet for longer than the
source's freshness limits raises a warning, then an error, and tells when it is back.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tradelake.operators.quality import FRESHNESS_ERROR_MIN, FRESHNESS_WARN_MIN
from tradelake.operators.silver import DEDUP_KEYS, DEDUP_ORDER, clean_trades

ALERTS = "symbol string, status string, quiet_since timestamp, raised_at timestamp"


def settled_trades(bronze: DataFrame, horizon: str = "31 days", watermark: str = "10 minutes") -> DataFrame:
    """Bronze stream -> clean trades, each once: of the copies whose trade times lie
    within ``horizon`` of each other the one with the least ingested_at (ties as in the
    batch), emitted when the watermark is ``horizon`` past the last of them."""
    order = [F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(c) for c in DEDUP_ORDER]
    keyed = (bronze.where(" and ".join(f"{k} is not null" for k in DEDUP_KEYS))
             .withColumn("traded_at", F.timestamp_millis(F.col("timestamp").cast("long")))
             .withWatermark("traded_at", watermark))
    first = (keyed.groupBy(*DEDUP_KEYS, F.session_window("traded_at", horizon).alias("copies"))
             .agg(F.min(F.struct(*order)).alias("first")))
    return clean_trades(first.select(*DEDUP_KEYS, *[F.col(f"first.{c}.value").alias(c) for c in DEDUP_ORDER]))


def silence_alerts(arrivals: DataFrame, warn_seconds: float = FRESHNESS_WARN_MIN * 60,
                   error_seconds: float = FRESHNESS_ERROR_MIN * 60) -> DataFrame:
    """Stream with a ``symbol`` -> its alerts: warn and error after so many seconds without
    a row, resumed with the first row after an alert.  Null symbols are ignored."""
    levels = ("ok", "warn", "error")

    def row(symbol, status, last, now):
        return pd.DataFrame({"symbol": [symbol], "status": [status], "quiet_since": [pd.Timestamp(last, unit="ms")],
                             "raised_at": [pd.Timestamp(now, unit="ms")]})

    def watch(key, frames, state):
        now = state.getCurrentProcessingTimeMs()
        if state.hasTimedOut:
            last, level = state.get
            level += 1
            state.update((last, level))
            if level + 1 < len(levels):
                state.setTimeoutDuration(max(1, round((error_seconds - warn_seconds) * 1000)))
            yield row(key[0], levels[level], last, now)
            return
        for _ in frames:        # rows only say that the symbol is alive
            pass
        if state.exists and state.get[1] > 0:
            yield row(key[0], "resumed", state.get[0], now)
        state.update((now, 0))
        state.setTimeoutDuration(max(1, round(warn_seconds * 1000)))

    # only the symbol itself reaches the workers
    return (arrivals.where("symbol is not null").select("symbol").groupBy("symbol")
            .applyInPandasWithState(watch, ALERTS, "last long, level int", "append", GroupStateTimeout.ProcessingTimeTimeout))
