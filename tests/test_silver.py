"""Dedup, cleaning and candle rules (hand-written edge cases)."""

from pyspark.sql import functions as F

from tests.conftest import MS, bronze_rows, trade
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import dedup_trades, stg_trades


def test_first_ingested_copy_wins(spark):
    df = bronze_rows(spark, [
        trade(trade_id=1, price=101.0, ingested="2024-01-01T10:00:02.000000+00:00"),
        trade(trade_id=1, price=100.0, ingested="2024-01-01T10:00:01.000000+00:00"),
    ])
    rows = stg_trades(df).collect()
    assert len(rows) == 1 and rows[0].price == 100.0


def test_invalid_first_copy_removes_trade(spark):
    df = bronze_rows(spark, [
        trade(trade_id=1, price=0.0, ingested="2024-01-01T10:00:01.000000+00:00"),
        trade(trade_id=1, price=100.0, ingested="2024-01-01T10:00:02.000000+00:00"),
    ])
    assert stg_trades(df).count() == 0


def test_same_id_two_symbols_kept(spark):
    df = bronze_rows(spark, [trade(symbol="BTCUSDT", trade_id=7), trade(symbol="ETHUSDT", trade_id=7)])
    assert stg_trades(df).count() == 2


def test_invalid_rows_dropped(spark):
    df = bronze_rows(spark, [
        trade(symbol=None, trade_id=1), trade(trade_id=None), trade(trade_id=3, qty=0.0),
        trade(trade_id=4, price=-1.0), trade(trade_id=5),
    ])
    assert [r.trade_id for r in stg_trades(df).collect()] == [5]


def test_null_ingested_at_sorts_last(spark):
    df = bronze_rows(spark, [
        trade(trade_id=1, price=1.0, ingested=None),
        trade(trade_id=1, price=2.0, ingested="2024-01-01T10:00:00.000000+00:00"),
    ])
    assert dedup_trades(df).collect()[0].price == 2.0


def test_dedup_idempotent(spark):
    from tests.conftest import SF_SMALL
    from tradelake.sources.adapters import lineitem_trades
    b = lineitem_trades(spark, SF_SMALL)
    once = dedup_trades(b)
    assert once.exceptAll(dedup_trades(once)).count() == 0


def test_equal_time_open_close_by_trade_id(spark):
    df = bronze_rows(spark, [trade(trade_id=2, price=20.0), trade(trade_id=1, price=10.0),
                             trade(trade_id=3, price=30.0, ms=MS + 10)])
    c = ohlcv(stg_trades(df)).collect()[0]
    assert (c.open, c.close, c.high, c.low) == (10.0, 30.0, 30.0, 10.0)


def test_one_sided_minute_and_null_side(spark):
    df = bronze_rows(spark, [trade(trade_id=1, qty=2.0, side="BUY"),
                             trade(trade_id=2, qty=3.0, side=None)])
    c = ohlcv(stg_trades(df)).collect()[0]
    assert c.buy_count == 1 and c.sell_count == 0
    assert c.sell_volume is None and c.buy_volume == 2.0
    assert c.volume_delta == -1.0          # NULL side counts as a sell in the delta
    assert c.trade_count == 2


def test_candle_properties(spark):
    from tests.conftest import SF_SMALL
    from tradelake.sources.adapters import event_trades
    c = ohlcv(stg_trades(event_trades(spark, SF_SMALL)))
    bad = c.where(~((F.col("low") <= F.col("open")) & (F.col("open") <= F.col("high"))
                    & (F.col("low") <= F.col("close")) & (F.col("close") <= F.col("high"))
                    & (F.col("buy_count") + F.col("sell_count") == F.col("trade_count"))
                    & (F.col("low") - 1e-6 <= F.col("vwap")) & (F.col("vwap") <= F.col("high") + 1e-6)))
    assert bad.count() == 0
    delta = c.where(F.abs(F.coalesce("buy_volume", F.lit(0.0)) - F.coalesce("sell_volume", F.lit(0.0))
                          - F.col("volume_delta")) > 1e-6)
    assert delta.count() == 0


def test_partition_count_independent(spark):
    from tests.conftest import SF_SMALL
    from tradelake.sources.adapters import event_trades
    b = event_trades(spark, SF_SMALL)
    one = ohlcv(stg_trades(b.coalesce(1)))
    many = ohlcv(stg_trades(b.repartition(7, "trade_id")))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_rounding_matches_binary_rounding(spark):
    from tradelake.functions import round_half_away
    df = spark.createDataFrame([(1.005,), (0.285,), (2.675,), (-0.0000001,), (2.5,)], "x double")
    got = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert got[:3] == [1.0, 0.28, 2.68]
    assert str(got[3]) == "-0.0"
    assert got[4] == 2.5
