"""Gold marts: windows, joins, tiers, ranks; blocked == plain."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import MS, SF_SMALL, bronze_rows, trade
from tradelake.operators import ranking, rolling
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.operators.volatility import cvd, mart_volatility, volatility_frame
from tradelake.operators.vwap import mart_vwap, rolling_vwap
from tradelake.operators.whales import mart_whale_trades, whale_trades
from tradelake.sources.adapters import event_trades, lineitem_trades

MIN = 60_000


def candles_of(spark, prices, minutes=None, symbol="BTCUSDT"):
    minutes = minutes or list(range(len(prices)))
    rows = [trade(symbol=symbol, trade_id=i + 1, price=p, ms=MS + m * MIN) for i, (p, m) in
            enumerate(zip(prices, minutes))]
    return ohlcv(stg_trades(bronze_rows(spark, rows)))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_single_candle_has_no_volatility_row(spark):
    assert mart_volatility(candles_of(spark, [100.0])).count() == 0


def test_constant_price_bands(spark):
    rows = mart_volatility(candles_of(spark, [50.0] * 21)).orderBy("candle_time").collect()
    last = rows[-1]
    assert last.std_20 == 0.0 and last.bb_upper == last.bb_lower == 50.0
    assert last.pct_b is None and last.log_return == 0.0


def test_two_candles_warm_up(spark):
    r = mart_volatility(candles_of(spark, [100.0, 110.0])).collect()[0]
    assert r.realized_vol_pct is None and r.annualized_vol is None
    assert r.sma_20 == 105.0


def test_row_frame_spans_gaps(spark):
    c = candles_of(spark, [10.0, 20.0, 30.0], minutes=[0, 5, 120])
    last = rolling_vwap(c).orderBy("candle_time").collect()[-1]
    assert last.vwap_30min == 20.0       # all three rows are inside 30 rows


def test_blocked_equals_plain(spark):
    c = ohlcv(stg_trades(event_trades(spark, SF_SMALL))).cache()
    r = rolling.blocked(c, ["symbol"], "candle_time", halo=20, block_rows=25)
    assert r.frame.select("_blk").distinct().count() > 5
    small_blocks = volatility_frame(c, "blocked", block_rows=25)
    cols = ["symbol", "candle_time", "sma_20", "std_20", "realized_vol_pct", "atr_14", "log_return"]
    assert same(small_blocks.select(cols), volatility_frame(c, "plain").select(cols))
    assert same(rolling_vwap(c, "blocked", block_rows=60), rolling_vwap(c, "plain"))


def test_blocked_halo_larger_than_gap(spark):
    c = ohlcv(stg_trades(event_trades(spark, SF_SMALL))).cache()
    r = rolling.blocked(c, ["symbol"], "candle_time", halo=59, block_rows=60)
    w = r.spec.rowsBetween(-59, 0)
    got = r.finish(r.frame.withColumn("s", F.sum("volume").over(w))).select("symbol", "candle_time", "s")
    p = rolling.plain(c, ["symbol"], "candle_time")
    exp = c.withColumn("s", F.sum("volume").over(p.spec.rowsBetween(-59, 0))).select("symbol", "candle_time", "s")
    assert same(got, exp)


def test_cvd_running_sum(spark):
    c = candles_of(spark, [1.0, 2.0, 3.0])
    assert [r.cvd for r in cvd(c).orderBy("candle_time").collect()] == [1.0, 2.0, 3.0]


def test_mart_vwap_keeps_row_count(spark):
    c = ohlcv(stg_trades(event_trades(spark, SF_SMALL)))
    assert mart_vwap(c).count() == c.count()


def test_whale_tiers_and_ranks(spark):
    vols = [50_000.0, 100_000.0, 500_000.0, 1_000_000.0, 49_999.99, 1_000_000.0]
    rows = [trade(trade_id=i + 1, price=v, qty=1.0, ms=MS + i) for i, v in enumerate(vols)]
    w = whale_trades(stg_trades(bronze_rows(spark, rows))).orderBy("trade_id").collect()
    assert [r.whale_tier for r in w] == ["small", "medium", "large", "mega", "mega"]
    assert [r.rank_in_hour for r in w] == [5, 4, 3, 1, 1]
    assert all(r.hour_total_trades == 6 for r in w)    # the 49,999.99 trade counts in totals


def test_split_rank_equals_rank(spark):
    s = stg_trades(lineitem_trades(spark, SF_SMALL)).withColumn("hour", F.date_trunc("hour", "traded_at"))
    s = s.withColumn("v", F.round(F.col("volume_usd") / 1e5) * 1e5)     # many ties
    a = ranking.rank_desc(s, ["symbol", "hour"], "v", "r", "split").select("symbol", "trade_id", "r")
    b = ranking.rank_desc(s, ["symbol", "hour"], "v", "r", "plain").select("symbol", "trade_id", "r")
    assert same(a, b)


def test_mart_whale_left_join_keeps_rows(spark):
    s = stg_trades(lineitem_trades(spark, SF_SMALL))
    assert mart_whale_trades(s).count() == whale_trades(s).count()


def test_marts_independent_of_partitioning(spark):
    b = event_trades(spark, SF_SMALL)
    c1 = ohlcv(stg_trades(b.coalesce(1)))
    c2 = ohlcv(stg_trades(b.repartition(5, "trade_id"))).repartition(3)
    assert same(mart_vwap(c1), mart_vwap(c2))
    assert same(mart_volatility(c1), mart_volatility(c2))
    assert same(cvd(c1), cvd(c2))


def test_hourly_sums_equal_candle_sums(spark):
    from tradelake.operators.vwap import hourly_vwap
    c = ohlcv(stg_trades(event_trades(spark, SF_SMALL)))
    h = hourly_vwap(c)
    per_hour = c.groupBy("symbol", F.date_trunc("hour", "candle_time").alias("hour")).agg(
        F.sum("trade_count").alias("tc"))
    j = h.join(per_hour, ["symbol", "hour"])
    assert j.count() == h.count() and j.where(F.col("tc") != F.col("trade_count")).count() == 0


def test_split_rank_hot_repeated_value(spark):
    """A third of the rows share one (symbol, hour, value): ranks still equal rank()."""
    rows = [("S", 0, float(v)) for v in range(200)] + [("S", 0, 77.0)] * 100 + [("T", 1, None)] * 3
    df = spark.createDataFrame(rows, "g string, h int, v double").withColumn("id", F.monotonically_increasing_id())
    a = ranking.rank_desc(df, ["g", "h"], "v", "r", "split").select("id", "r")
    b = ranking.rank_desc(df, ["g", "h"], "v", "r", "plain").select("id", "r")
    assert same(a, b)
    assert a.count() == df.count()


def test_dust_trades_keep_their_price(spark):
    from tradelake.operators.candles import ohlcv
    from tradelake.operators.silver import stg_trades
    from tests.conftest import bronze_rows, trade
    c = ohlcv(stg_trades(bronze_rows(spark, [trade(price=0.00001, qty=0.000001)]))).first()
    assert c.open == 0.00001 and c.vwap == 0.00001


def test_exact_sums_are_near_plain_sums(spark):
    from pyspark.sql import functions as F
    from tests.conftest import SF_SMALL
    from tradelake.plans.registry import events_candles, events_stg
    plain = (events_stg(spark, SF_SMALL).groupBy("symbol", F.date_trunc("minute", "traded_at").alias("candle_time"))
             .agg(F.sum(F.col("price") * F.col("quantity")).alias("money"), F.sum("quantity").alias("size")))
    for r in events_candles(spark, SF_SMALL).join(plain, ["symbol", "candle_time"]).collect():
        assert abs(r.vwap - r.money / r["size"]) < 1e-5 and abs(r.volume - r["size"]) < 1e-6


def test_pivot_refuses_an_unlisted_symbol(spark):
    import pytest
    from tests.conftest import bronze_rows, trade
    from tradelake.operators.silver import stg_trades
    from tradelake.plans.serving import buy_pressure_pivot
    stg = stg_trades(bronze_rows(spark, [trade(symbol="NEW")]))
    with pytest.raises(Exception, match="symbol without a column: NEW"):
        buy_pressure_pivot(stg, ["BTCUSDT"]).collect()
