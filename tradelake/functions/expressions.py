"""Domain expressions: sides, whale tiers, time buckets, ordering keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Trade sides; the symbols the source streams; whale tiers and their lower
# bounds in USD (first match wins, "small" is everything else); the default
# whale threshold in USD; the topic suffix of the per-symbol Kafka topics.
BUY, SELL = "BUY", "SELL"
SIDES = ["BUY", "SELL"]
FEED_SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT"]
WHALE_TIERS = [("mega", 1_000_000.0), ("large", 500_000.0), ("medium", 100_000.0)]
WHALE_TIER_ELSE = "small"
TIER_ORDER = ["small", "medium", "large", "mega"]
DEFAULT_WHALE_THRESHOLD = 50_000.0
TOPIC_SUFFIX = "_trades"
# ---------------------------------------------------------------------------


def side_from_maker(buyer_is_maker: Column) -> Column:
    """``m = true`` means the seller initiated: SELL; otherwise BUY.

    A NULL flag counts as "not maker" (BUY), as ``not None`` does in Python.
    """
    return F.when(buyer_is_maker.eqNullSafe(F.lit(True)), F.lit(SELL)).otherwise(F.lit(BUY))


def whale_tier(volume_usd: Column) -> Column:
    expr = None
    for name, bound in WHALE_TIERS:
        cond = volume_usd >= F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(WHALE_TIER_ELSE))


def kafka_topic(symbol: Column) -> Column:
    return F.concat(F.lower(symbol), F.lit(TOPIC_SUFFIX))


def share_pct(part: Column, total: Column) -> Column:
    return part / F.nullif(total, F.lit(0)) * F.lit(100.0)


def clip_positive(c: Column) -> Column:
    """``clip(lower=0)`` keeping NULL as NULL (``greatest`` would give 0)."""
    return F.when(c > 0, c).when(c.isNotNull(), F.lit(0.0))


def clip_negative(c: Column) -> Column:
    """``clip(upper=0)`` keeping NULL as NULL."""
    return F.when(c < 0, c).when(c.isNotNull(), F.lit(0.0))


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(interval: str) -> int:
    """'1 minute' / '15 minutes' / '1 hour' / '2 days' -> seconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+?)s?\s*", interval)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported interval: {interval!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def time_bucket(ts: Column, interval: str) -> Column:
    """Start of the tumbling bucket of ``interval`` that holds ``ts`` (UTC).

    Whole units use ``date_trunc``; other widths floor the epoch offset.  Both
    are plain projections, so the aggregate that groups on them stays a
    partial (map-side) hash aggregate.
    """
    secs = interval_seconds(interval)
    for unit, width in _UNITS.items():
        if secs == width and unit != "week":
            return F.date_trunc(unit, ts)
    width_us = secs * 1_000_000
    return F.timestamp_micros(F.floor(F.unix_micros(ts) / F.lit(width_us)).cast("long") * F.lit(width_us))


_SHIFT = "9223372036854775808"        # 2^63: makes any bigint non-negative
_SCALE = "100000000000000000000"      # 10^20 > 2^64: room for the shifted id


def order_key(ts: Column, tie: Column) -> Column:
    """One totally ordered decimal(38,0) for (timestamp, tie-break id).

    ``min_by/max_by`` on a struct ordering falls back to sort-based
    aggregation; a decimal key keeps them in the hash aggregate with its
    map-side partial step.  micros * 10^20 + (id + 2^63) orders exactly like
    the pair (micros, id) and fits 38 digits for any timestamp before year 5000;
    times beyond count as the last one that fits, then go by id.
    """
    dec = "decimal(38,0)"
    bound = 95_000_000_000_000_000
    micros = F.least(F.greatest(F.unix_micros(ts), F.lit(-bound)), F.lit(bound))
    return (micros.cast(dec) * F.lit(_SCALE).cast(dec)
            + (tie.cast(dec) + F.lit(_SHIFT).cast(dec)))
