"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from tradelake.functions.numeric import round_half_away, safe_div, as_decimal, xsum, xavg, xsum_over
from tradelake.functions.expressions import (
    BUY, SELL, SIDES, FEED_SYMBOLS, WHALE_TIERS, TIER_ORDER,
    side_from_maker, whale_tier, time_bucket, order_key, kafka_topic,
    share_pct, clip_positive, clip_negative,
)

__all__ = [
    "round_half_away", "safe_div", "as_decimal", "xsum", "xavg", "xsum_over", "BUY", "SELL", "SIDES",
    "FEED_SYMBOLS", "WHALE_TIERS", "TIER_ORDER", "side_from_maker",
    "whale_tier", "time_bucket", "order_key", "kafka_topic", "share_pct",
    "clip_positive", "clip_negative",
]
