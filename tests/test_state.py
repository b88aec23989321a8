"""Keyed state on streams and mergeable candle states."""

import time

from pyspark.sql import functions as F

from tests.conftest import MS, SF_SMALL, bronze_rows, trade
from tradelake.operators import candle_state as CS
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.session import new_scratch_path
from tradelake.sources.adapters import event_trades
from tradelake.streaming import jobs as P
from tradelake.streaming import state as ST


def rows(df):
    return sorted(map(str, df.collect()))


def test_copies_in_any_order_give_what_the_batch_gives(spark):
    late, early = "2024-01-01T12:00:00.000000+00:00", "2024-01-01T09:00:00.000000+00:00"
    first = [trade(trade_id=1, price=1.0, ingested=late), trade(trade_id=2, price=5.0, ingested=early),
             trade(trade_id=3, price=7.0, ingested=None), trade(trade_id=None), trade(symbol="ETHUSDT", trade_id=1, price=3.0),
             trade(trade_id=4, price=8.0, ingested=late), trade(trade_id=4, price=8.0, ingested=late)]
    then = [trade(trade_id=1, price=2.0, ingested=early, ms=MS + 120_000),        # the better copy comes later, in another minute
            trade(trade_id=2, price=6.0, ingested=late),
            trade(trade_id=3, price=9.0, ingested=early),
            trade(trade_id=4, price=-1.0, ingested=early)]                        # the best copy is not valid: the trade goes
    clock = [trade(symbol="CLOCK", trade_id=9, ms=MS + 90 * 86_400_000)]
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    for part in (first, then, clock):
        bronze_rows(spark, part).coalesce(1).write.mode("append").parquet(src)
        P.write_append(ST.settled_trades(P.bronze_stream(spark, src)), out, ck).awaitTermination()
    want = stg_trades(bronze_rows(spark, first + then))
    assert rows(spark.read.parquet(out).select(*want.columns)) == rows(want) and want.count() == 4


def test_a_silent_symbol_raises_warning_error_and_return(spark):
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))

    def feed(*symbols):
        bronze_rows(spark, [trade(symbol=s) for s in symbols]).coalesce(1).write.mode("append").parquet(src)
    feed("A", "B", None)
    alerts = ST.silence_alerts(P.bronze_stream(spark, src), 6, 12)
    query = (alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(processingTime="1 second").start())
    try:
        deadline, seen = time.time() + 120, []
        while time.time() < deadline:
            feed("B")           # B goes on, A has stopped
            time.sleep(1)
            try:
                seen = [r.status for r in spark.read.schema(ST.ALERTS).parquet(out).where("symbol = 'A'").orderBy("raised_at").collect()]
            except Exception:   # noqa: BLE001  nothing written yet
                seen = []
            if "resumed" in seen:
                break
            if "error" in seen:
                feed("A")
        assert seen[:3] == ["warn", "error", "resumed"]
        assert query.exception() is None
        first = spark.read.schema(ST.ALERTS).parquet(out).where("symbol = 'A' and status = 'warn'").first()
        assert (first.raised_at - first.quiet_since).total_seconds() >= 6
    finally:
        query.stop()


def test_states_merge_in_any_order(spark):
    trades = stg_trades(event_trades(spark, SF_SMALL)).persist()
    want = rows(ohlcv(trades))
    parts = [CS.candle_states(trades.where(F.pmod(F.xxhash64("trade_id"), F.lit(3)) == i)) for i in range(3)]
    a, b, c = parts
    assert rows(CS.finished(CS.merge_states(a, CS.merge_states(b, c)))) == want
    assert rows(CS.finished(CS.merge_states(CS.merge_states(c, a), b))) == want
    assert CS.merge_states(a).dtypes == a.dtypes
    assert CS.finished(CS.candle_states(trades.limit(0))).count() == 0


def test_every_width_from_one_scan_and_one_shuffle(spark):
    trades = stg_trades(event_trades(spark, SF_SMALL)).persist()
    path = new_scratch_path(spark, "states")
    CS.candle_states(trades).write.parquet(path)
    got = CS.all_widths(spark.read.parquet(path))
    for width in CS.WIDTHS:
        assert rows(got.where(F.col("width") == width).drop("width")) == rows(ohlcv(trades, width))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    final = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan and final.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in final
