"""Data-quality assertions: each has a passing and a failing case."""

from pyspark.sql import functions as F

from tests.conftest import bronze_rows, trade
from tradelake.operators import quality as Q


def test_not_null(spark):
    df = bronze_rows(spark, [trade(trade_id=None), trade(trade_id=2)])
    r = {x.column_name: (x.failures, x.status) for x in Q.not_null(df, "t", ["trade_id", "symbol"]).collect()}
    assert r == {"trade_id": (1, "fail"), "symbol": (0, "pass")}


def test_unique(spark):
    df = bronze_rows(spark, [trade(trade_id=1), trade(trade_id=1), trade(symbol="ETHUSDT", trade_id=1)])
    r = Q.unique(df, "t", ["symbol", "trade_id"]).collect()
    assert [(x.key_value, x.n) for x in r] == [("BTCUSDT|1", 2)]
    assert Q.unique(df.dropDuplicates(), "t", ["symbol", "trade_id"]).count() == 0


def test_accepted_values(spark):
    df = bronze_rows(spark, [trade(side="BUY"), trade(side="HOLD"), trade(side=None)])
    r = Q.accepted_values(df, "t", "side", ["BUY", "SELL"]).collect()
    assert [(x.value, x.n) for x in r] == [("HOLD", 1)]


def test_freshness_levels(spark):
    df = spark.createDataFrame([("a", "2024-01-01 09:51:00"), ("b", "2024-01-01 09:49:00"),
                                ("c", "2024-01-01 09:29:00")], "k string, t string")
    r = Q.freshness(df, "t", F.col("t").cast("timestamp"), F.lit("2024-01-01 10:00:00").cast("timestamp"),
                    by=["k"]).collect()
    assert {x.k: x.status for x in r} == {"a": "pass", "b": "warn", "c": "error"}


def test_range_check(spark):
    df = bronze_rows(spark, [trade(price=1.0), trade(price=-1.0)])
    r = Q.range_check(df, "t", {"price_positive": F.col("price") > 0}).collect()[0]
    assert (r.failures, r.status) == (1, "fail")


def test_report_has_freshness_ids_and_sides(spark):
    from tradelake.plans.build import layers, quality_report
    df = bronze_rows(spark, [trade(trade_id=1), trade(trade_id=1), trade(trade_id=2, side="HOLD", qty=1000.0),
                             trade(symbol="ETHUSDT", trade_id=2, qty=1000.0)])
    built = layers(df)
    got = {}
    for at in ("10:05", "10:20", "11:00"):
        as_of = F.lit(f"2024-01-01 {at}:00").cast("timestamp")
        r = {(x.table_name, x.check): (x.failures, x.status) for x in quality_report(built, df, as_of).collect()}
        got[at] = r["bronze_trades", "freshness:ingested_at"]
    assert got == {"10:05": (0, "pass"), "10:20": (1, "warn"), "11:00": (1, "error")}
    assert r["bronze_trades", "unique:trade_id"] == (2, "fail")
    assert r["mart_whale_trades", "unique:trade_id"] == (1, "fail")
    assert r["bronze_trades", "accepted_values:side"] == (1, "fail")
    assert r["mart_whale_trades", "accepted_values:side"] == (1, "fail")
