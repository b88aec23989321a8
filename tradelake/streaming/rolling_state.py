"""The rolling VWAP mart as keyed state on a stream of closed candles.

Each symbol keeps a ring of its last 60 candles' exact volumes and the candles of
the hours that are still open.  An event-time timer closes an hour once the
watermark has passed its end; its candles then go through the ring in order of
time, and each is emitted with the sums of its frames and of its hour.  A candle is
read once, so no micro-batch looks back over stored candles.  The state only keeps
books: divisions and rounding are the expressions of the batch mart, so both give
the same numbers.

A symbol's state holds the ring, the hours that the watermark has not passed and, for
one batch, that batch's candles (bound a backlog by ``maxFilesPerTrigger``).  Before the
shuffle there is one row for a symbol's minute, so the busiest symbol brings no more
rows than any other.
"""

from __future__ import annotations

import json
from decimal import Context, Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tradelake.functions import as_decimal, round_half_away, safe_div
from tradelake.schema import CANDLES_READ_SCHEMA, MART_VWAP_COLUMNS, OHLCV_COLUMNS

WIDTHS = (30, 60)
HOUR_US = 3_600_000_000
USD_SCALE, VOLUME_SCALE = 2, 8      # decimals that a candle's volumes carry
EXACT = Context(prec=60)
BOOKS = ("symbol string, candle_time timestamp, close double, "
         + "".join(f"usd_{w} decimal(38,{USD_SCALE}), volume_{w} decimal(38,{VOLUME_SCALE}), " for w in WIDTHS)
         + f"hour_usd decimal(38,{USD_SCALE}), hour_volume decimal(38,{VOLUME_SCALE}), "
           "hour_trades long, hour_high double, hour_low double")


def candle_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Closed candles as ``stream_candles`` writes them."""
    reader = spark.readStream.schema(CANDLES_READ_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*OHLCV_COLUMNS)


def _units(value, scale: int) -> int:
    return 0 if value is None else int(EXACT.scaleb(value, scale))


def _amount(units: int, scale: int) -> Decimal:
    return EXACT.scaleb(Decimal(units), -scale)


def _totals(rows: list) -> list:
    """Money, volume, trades, high and low of candles."""
    high = [r[4] for r in rows if r[4] is not None]
    low = [r[5] for r in rows if r[5] is not None]
    return [_amount(sum(r[1] for r in rows), USD_SCALE), _amount(sum(r[2] for r in rows), VOLUME_SCALE),
            sum(r[3] for r in rows), max(high, default=None), min(low, default=None)]


def _keep_books(key, frames, state):
    ring, waiting, closed = state.get if state.exists else ("[]", "{}", None)
    ring, waiting = json.loads(ring), {int(us): row for us, row in json.loads(waiting).items()}
    for frame in frames:
        for us, close, usd, volume, trades, high, low in zip(*(frame[c] for c in (
                "us", "close", "usd", "size", "trade_count", "high", "low"))):
            if closed is None or us >= closed:
                number = lambda v: None if pd.isna(v) else float(v)
                waiting[int(us)] = [number(close), _units(usd, USD_SCALE), _units(volume, VOLUME_SCALE),
                                    0 if pd.isna(trades) else int(trades), number(high), number(low)]
    passed = state.getCurrentWatermarkMs() * 1000
    hours: dict[int, list[int]] = {}
    for us in sorted(waiting):
        hours.setdefault(us // HOUR_US, []).append(us)
    out, open_end = [], None
    for hour, times in hours.items():
        end = (hour + 1) * HOUR_US
        if end > passed:
            open_end = end
            break
        rows = [waiting.pop(us) for us in times]
        of_hour = _totals(rows)
        for us, row in zip(times, rows):
            ring = [*ring, row[1:3]][-max(WIDTHS):]
            sums = [_amount(sum(r[i] for r in ring[-w:]), scale) for w in WIDTHS
                    for i, scale in ((0, USD_SCALE), (1, VOLUME_SCALE))]
            out.append([key[0], pd.Timestamp(us, unit="us"), row[0], *sums, *of_hour])
        closed = end
    state.update((json.dumps(ring), json.dumps(waiting), closed))
    if open_end is not None:
        state.setTimeoutTimestamp(open_end // 1000 - 1)
    if out:
        yield pd.DataFrame(out, columns=[c.split()[0] for c in BOOKS.split(", ")])


def rolling_vwap_state(candles: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Stream of closed candles -> rows of ``mart_vwap``, each once its hour is over.

    Candles may come in any order within ``watermark``; later ones are ignored, as are
    rows without symbol or time.  Of rows of one symbol and time that wait together
    the last one counts; null volumes count as zero.
    """
    books = (candles.where("symbol is not null and candle_time is not null")
             .withWatermark("candle_time", watermark)
             .select("symbol", "candle_time", F.unix_micros("candle_time").alias("us"), "close",
                     as_decimal("volume_usd", USD_SCALE).alias("usd"), as_decimal("volume", VOLUME_SCALE).alias("size"),
                     "trade_count", "high", "low")
             .groupBy("symbol")
             .applyInPandasWithState(_keep_books, BOOKS, "ring string, waiting string, closed long", "append",
                                     GroupStateTimeout.EventTimeTimeout))
    price = {w: safe_div(F.col(f"usd_{w}").cast("double"), F.col(f"volume_{w}").cast("double")) for w in WIDTHS}
    hour_usd = F.col("hour_usd").cast("double")
    return books.select(
        "symbol", "candle_time", "close",
        *[round_half_away(price[w], 6).alias(f"vwap_{w}min") for w in WIDTHS],
        round_half_away(F.col("close") - price[min(WIDTHS)], 6).alias("price_vs_vwap"),
        round_half_away(safe_div(hour_usd, F.col("hour_volume").cast("double")), 6).alias("hourly_vwap"),
        F.col("hour_high").alias("hourly_high"), F.col("hour_low").alias("hourly_low"),
        round_half_away(hour_usd, 2).alias("hourly_volume_usd"), F.col("hour_trades").alias("hourly_trade_count"),
    ).select(*MART_VWAP_COLUMNS)
