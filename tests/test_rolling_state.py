"""The rolling VWAP mart as keyed state equals the batch mart."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.operators.vwap import mart_vwap
from tradelake.session import new_scratch_path
from tradelake.sources.adapters import event_trades
from tradelake.streaming import jobs as P
from tradelake.streaming import rolling_state as RS


def rows(df):
    return sorted(map(str, df.collect()))


def test_state_equals_the_batch_after_batches_and_restarts(spark):
    src, out, ck, base = (new_scratch_path(spark, n) for n in ("s", "o", "c", "b"))
    ohlcv(stg_trades(event_trades(spark, SF_SMALL))).write.parquet(base)
    candles = spark.read.parquet(base)
    ms = F.unix_millis("candle_time")
    a, b = candles.select(F.percentile_approx(ms, F.array(F.lit(0.3), F.lit(0.7)))).first()[0]
    a += 60_000 - a % 60_000    # inside an hour: the open hour is carried over the restart
    clock = candles.limit(1).withColumns({"symbol": F.lit("CLOCK"), "candle_time": F.lit("2030-01-01").cast("timestamp")})
    odd = candles.limit(1).withColumn("symbol", F.lit(None).cast("string"))
    parts = (candles.where(ms < a).repartition(3).unionByName(odd), candles.where((ms >= a) & (ms < b)).repartition(3),
             candles.where(ms >= b).orderBy(F.desc("candle_time")), clock)
    for part in parts:
        part.write.mode("append").parquet(src)
        P.write_append(RS.rolling_vwap_state(RS.candle_stream(spark, src)), out, ck).awaitTermination()
    want, got = mart_vwap(candles), spark.read.parquet(out)
    assert got.dtypes == want.dtypes
    assert want.count() > 60 and rows(got) == rows(want)


def test_late_candles_are_ignored_and_the_last_repeat_counts(spark):
    src, out, ck, base = (new_scratch_path(spark, n) for n in ("s", "o", "c", "b"))
    ohlcv(stg_trades(event_trades(spark, SF_SMALL))).limit(1).write.parquet(base)
    one = spark.read.parquet(base)

    def candle(time, symbol="A", volume=2.0):
        return one.withColumns({"symbol": F.lit(symbol), "candle_time": F.lit(time).cast("timestamp"), "volume": F.lit(volume),
                                "volume_usd": F.lit(10.0), "close": F.lit(6.0)})
    feed = (candle("2024-01-01 10:00:00", volume=5.0), candle("2024-01-01 10:00:00"), candle("2024-01-01 12:30:00", "CLOCK"),
            candle("2024-01-01 10:01:00"), candle("2024-01-01 13:00:00", volume=0.0), candle("2030-01-01 00:00:00", "CLOCK"))
    for part in feed:
        part.coalesce(1).write.mode("append").parquet(src)
        P.write_append(RS.rolling_vwap_state(RS.candle_stream(spark, src)), out, ck).awaitTermination()
    got = spark.read.parquet(out).where("symbol = 'A'").orderBy("candle_time").collect()
    assert [(str(r.candle_time)[11:], r.vwap_30min, r.hourly_vwap) for r in got] == [("10:00:00", 5.0, 5.0), ("13:00:00", 10.0, None)]
