"""Structured Streaming: sources, sinks, restarts, lateness, parity with batch."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.session import new_scratch_path
from tradelake.sources import raw as R
from tradelake.sources.adapters import event_trades
from tradelake.streaming import jobs as P


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def write_frames(spark, trades, path, damaged=False):
    frames = R.frames_from_trades(trades)
    if damaged:
        frames = frames.unionByName(R.damaged_frames(frames))
    frames.select("value").write.mode("append").text(path)


def test_stream_source_and_bronze_and_rejects(spark):
    tr = event_trades(spark, SF_SMALL)
    src, bronze, rej, ck = (new_scratch_path(spark, n) for n in ("f", "b", "r", "c"))
    write_frames(spark, tr, src, damaged=True)
    q = P.bronze_ingest(P.frame_stream(spark, src), bronze, rej, ck, available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(bronze).select(*tr.columns).drop("ingested_at")
    assert same(got, tr.drop("ingested_at"))
    rejects = spark.read.parquet(rej)
    assert {r.reject_reason for r in rejects.select("reject_reason").distinct().collect()} == set(R.DAMAGES)
    assert rejects.where("reject_reason = 'bad_number:p'").count() == tr.count()


def test_replayed_batch_replaces_its_rows(spark):
    tr = event_trades(spark, SF_SMALL)
    bronze, rej = new_scratch_path(spark, "b"), new_scratch_path(spark, "r")
    frames = R.frames_from_trades(tr)
    batch = frames.unionByName(R.damaged_frames(frames))
    for batch_id in (0, 1, 1):
        P._ingest_batch(bronze, rej)(batch, batch_id)
    from tradelake.sources.bronze import read_bronze
    assert read_bronze(spark, bronze).count() == 2 * tr.count()
    assert spark.read.parquet(rej).where("reject_reason = 'bad_number:t'").count() == 2 * tr.count()


def test_stream_restart_no_dups(spark):
    tr = event_trades(spark, SF_SMALL)
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    cut = 1_705_276_800_000            # 2024-01-15: restart splits the data in time
    tr.where(F.col("timestamp") < cut).write.parquet(src)
    run = lambda: P.write_append(P.stream_trades(P.bronze_stream(spark, src)), out, ck).awaitTermination()
    run()
    tr.where(F.col("timestamp") >= cut).write.mode("append").parquet(src)
    run()
    run()   # nothing new: no output
    got = spark.read.parquet(out)
    assert got.count() == stg_trades(tr).count()
    assert same(got.select(*stg_trades(tr).columns), stg_trades(tr))


def test_stream_dedup_keeps_first_arrival(spark):
    from tradelake.plans.registry import replays
    tr = event_trades(spark, SF_SMALL)
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    tr.write.parquet(src)
    run = lambda: P.write_append(P.stream_trades(P.bronze_stream(spark, src), "31 days"), out, ck).awaitTermination()
    run()
    replays(tr).write.mode("append").parquet(src)
    run()
    assert same(spark.read.parquet(out).select(*stg_trades(tr).columns), stg_trades(tr))


def test_stream_ohlcv_parity_and_hourly(spark):
    tr = event_trades(spark, SF_SMALL)
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    tr.write.parquet(src)
    candles = P.stream_candles(P.stream_trades(P.bronze_stream(spark, src), "10 minutes"))
    P.write_append(candles, out, ck).awaitTermination()
    wm = tr.select(F.max(F.timestamp_millis("timestamp"))).first()[0]
    batch = ohlcv(stg_trades(tr)).where(
        F.col("candle_time") + F.expr("INTERVAL 1 MINUTE") <= F.lit(wm) - F.expr("INTERVAL 10 MINUTES"))
    assert same(spark.read.parquet(out).select(*batch.columns), batch)
    # chained hourly roll-up on the same stream
    out2, ck2 = new_scratch_path(spark, "h"), new_scratch_path(spark, "hc")
    P.write_append(P.stream_hourly(P.stream_candles(P.stream_trades(P.bronze_stream(spark, src)), keep_window=True)),
                   out2, ck2).awaitTermination()
    from tradelake.operators.vwap import hourly_vwap
    hv = hourly_vwap(ohlcv(stg_trades(tr)))
    got = spark.read.parquet(out2).select(*hv.columns)
    assert got.count() > 0 and got.exceptAll(hv).count() == 0


def test_late_rows(spark):
    base = 1_704_103_200_000
    from tests.conftest import bronze_rows, trade
    first = bronze_rows(spark, [trade(trade_id=1, ms=base + 20 * 60_000)])
    late = bronze_rows(spark, [trade(trade_id=2, ms=base + 15 * 60_000)])   # 5 min late
    for wm, expect in (("1 minute", 1), ("10 minutes", 2)):
        src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
        first.write.parquet(src)
        run = lambda: P.write_append(P.stream_trades(P.bronze_stream(spark, src), wm), out, ck).awaitTermination()
        run()
        # a later batch advances the watermark, then the late row arrives
        bronze_rows(spark, [trade(trade_id=3, ms=base + 21 * 60_000)]).write.mode("append").parquet(src)
        run()
        late.write.mode("append").parquet(src)
        run()
        ids = {r.trade_id for r in spark.read.parquet(out).collect()}
        assert (2 in ids) == (expect == 2), wm


def test_stream_whale_alert_and_metrics(spark):
    tr = event_trades(spark, SF_SMALL)      # no replayed copies: stream dedup == batch dedup
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    tr.write.parquet(src)
    trades = P.stream_trades(P.bronze_stream(spark, src), "3650 days")
    alerts = P.whale_alerts(trades, 5_000.0).observe("ingest", F.count(F.lit(1)).alias("alerts"),
                                            F.max("volume_usd").alias("max_usd"))
    q = P.write_append(alerts, out, ck)
    q.awaitTermination()
    from tradelake.operators.whales import whale_filter
    assert spark.read.parquet(out).count() == whale_filter(stg_trades(tr), 5_000.0).count() > 0
    observed = [p["observedMetrics"]["ingest"] for p in q.recentProgress if p.get("observedMetrics")]
    assert observed and observed[0]["alerts"] > 0
    assert any(p["numInputRows"] > 0 for p in q.recentProgress)


def test_stream_whale_context(spark):
    from tradelake.operators.whales import hourly_market, whale_trades
    tr = event_trades(spark, SF_SMALL)      # no replayed copies: stream dedup == batch dedup
    stg = stg_trades(tr)
    hm_path, src, out, ck = (new_scratch_path(spark, n) for n in ("hm", "s", "o", "c"))
    hourly_market(stg).write.parquet(hm_path)
    tr.write.parquet(src)
    q = (P.stream_trades(P.bronze_stream(spark, src), "3650 days").writeStream
         .foreachBatch(P.whale_context_batch(hm_path, out, 5_000.0)).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out).select("trade_id", "symbol", "hour_total_trades")
    exp = whale_trades(stg, 5_000.0).select("trade_id", "symbol", "hour_total_trades")
    assert got.count() > 0 and same(got, exp)


def test_progress_listener_sees_observed_metrics(spark):
    import time
    from tradelake.streaming.metrics import ProgressLog, observe_ingest
    tr = event_trades(spark, SF_SMALL)
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    tr.write.parquet(src)
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        q = P.write_append(observe_ingest(P.stream_trades(P.bronze_stream(spark, src))), out, ck)
        q.awaitTermination()
        for _ in range(50):          # listener events are delivered asynchronously
            if any(e["observed"] for e in log.events):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    seen = [e["observed"]["ingest"] for e in log.events if e["observed"]]
    assert seen and sum(x["rows"] for x in seen) == stg_trades(tr).count()


def test_scheduled_run_gates_checks(spark):
    import pytest
    from tradelake.plans.build import BuildFailed, scheduled_run
    from tradelake.sources.releases import Releases
    tr = event_trades(spark, SF_SMALL)
    built, report = scheduled_run(spark, tr, Releases(spark, "gate", new_scratch_path(spark, "gate")))
    assert report.where(F.col("status") == "fail").count() == 0
    assert built.mart_vwap.count() == built.candles.count()
    with pytest.raises(BuildFailed):
        scheduled_run(spark, tr.drop("price"))


def test_stream_rolling_parity_with_late_trade(spark):
    """T10: incremental refresh equals a full rebuild, also after a late trade."""
    from tradelake.operators.volatility import mart_volatility
    from tradelake.operators.vwap import mart_vwap
    from tradelake.sources import bronze as B
    from tradelake.streaming import incremental as I
    tr = event_trades(spark, SF_SMALL)
    bronze, cpath, vpath, opath, ck = (new_scratch_path(spark, n) for n in ("b", "cd", "v", "vo", "ck"))
    cut = 1_705_276_800_000                      # 2024-01-15
    B.write_bronze(tr.where(F.col("timestamp") < cut), bronze)

    def run():
        q = I.start_refresh(P.bronze_stream(spark, bronze), bronze, cpath, vpath, opath, ck, available_now=True)
        q.awaitTermination()

    def check(expected_bronze):
        c = ohlcv(stg_trades(expected_bronze))
        got_c = spark.read.parquet(cpath).drop("day")
        assert same(got_c.select(*c.columns), c)
        assert same(spark.read.parquet(vpath).drop("day").select(*mart_vwap(c).columns), mart_vwap(c))
        assert same(spark.read.parquet(opath).drop("day").select(*mart_volatility(c).columns), mart_volatility(c))

    run()
    check(tr.where(F.col("timestamp") < cut))
    B.write_bronze(tr.where(F.col("timestamp") >= cut), bronze)
    run()
    check(tr)
    # a late trade into a candle ten days back changes that candle and the rows after it
    from tests.conftest import bronze_rows, trade
    late = bronze_rows(spark, [trade(symbol="CLICK", trade_id=10_000_001, price=999.0, qty=3.0,
                                     ms=1_704_888_000_000)])     # 2024-01-10 12:00
    B.write_bronze(late, bronze)
    run()
    check(tr.unionByName(late))


def _refreshed(spark, parts):
    """Candles and marts after one incremental run for each part of bronze."""
    from tradelake.sources import bronze as B
    from tradelake.streaming import incremental as I
    bronze, cpath, vpath, opath, ck = (new_scratch_path(spark, n) for n in ("b", "cd", "v", "vo", "ck"))
    for part in parts:
        B.write_bronze(part, bronze)
        I.start_refresh(P.bronze_stream(spark, bronze), bronze, cpath, vpath, opath, ck, available_now=True).awaitTermination()
    return I.read_candles(spark, cpath), vpath


def _marts(spark, parts):
    """(incremental, full) of both marts."""
    from tradelake.operators.volatility import mart_volatility
    from tradelake.operators.vwap import mart_vwap
    from tradelake.sources import bronze as B
    from tradelake.streaming import incremental as I
    bronze, cpath, vpath, opath, ck = (new_scratch_path(spark, n) for n in ("b", "cd", "v", "vo", "ck"))
    whole = None
    for part in parts:
        B.write_bronze(part, bronze)
        I.start_refresh(P.bronze_stream(spark, bronze), bronze, cpath, vpath, opath, ck, available_now=True).awaitTermination()
        whole = part if whole is None else whole.unionByName(part)
    candles = ohlcv(stg_trades(whole))
    out = []
    for path, mart in ((vpath, mart_vwap(candles)), (opath, mart_volatility(candles))):
        schema = T.StructType([*mart.schema.fields, T.StructField("day", T.StringType())])
        got = spark.read.schema(schema).option("basePath", path).parquet(path)
        out.append((sorted(map(str, got.select(*mart.columns).collect())), sorted(map(str, mart.collect()))))
    return out


def test_a_day_that_loses_its_last_candle_leaves_no_mart_row(spark):
    from tests.conftest import MS, bronze_rows, trade
    day = 86_400_000
    first = [trade(trade_id=i, ms=MS + i * 60_000, price=100.0 + i) for i in range(3)] + [trade(trade_id=9, ms=MS + day)]
    moved = [trade(trade_id=9, ms=MS + 300_000, ingested="2024-01-01T09:00:00.000000+00:00")]
    for got, want in _marts(spark, [bronze_rows(spark, first), bronze_rows(spark, moved)]):
        assert got == want


def test_a_day_left_with_the_first_candle_of_all_leaves_no_volatility_row(spark):
    from tests.conftest import MS, bronze_rows, trade
    day = 86_400_000
    first = [trade(trade_id=1, ms=MS), trade(trade_id=2, ms=MS + day), trade(trade_id=3, ms=MS + 2 * day, price=101.0)]
    moved = [trade(trade_id=1, ms=MS + day + 60_000, price=99.0, ingested="2024-01-01T09:00:00.000000+00:00")]
    for got, want in _marts(spark, [bronze_rows(spark, first), bronze_rows(spark, moved)]):
        assert got == want


def test_a_copy_in_another_minute_counts_once(spark):
    from tests.conftest import MS, bronze_rows, trade
    first = [trade(trade_id=1, ms=MS), trade(trade_id=2, ms=MS + 60_000), trade(trade_id=3, ms=MS + 86_400_000)]
    copies = [trade(trade_id=1, ms=MS + 120_000, ingested="2024-01-01T11:00:00.000000+00:00"),
              # an earlier copy moves the trade, and its day loses the only candle
              trade(trade_id=3, ms=MS + 180_000, ingested="2024-01-01T09:00:00.000000+00:00"),
              trade(trade_id=4, ms=MS + 60_000)]
    one, two = bronze_rows(spark, first), bronze_rows(spark, copies)
    got, _ = _refreshed(spark, [one, two])
    expected = ohlcv(stg_trades(one.unionByName(two)))
    assert same(got.select(*expected.columns), expected) and expected.count() == 3


def test_symbols_that_look_like_numbers_stay_text(spark):
    from tests.conftest import MS, bronze_rows, trade
    rows = [bronze_rows(spark, [trade(symbol="0700", trade_id=i, ms=MS + i * 60_000)]) for i in (1, 2)]
    got, _ = _refreshed(spark, rows)
    assert sorted(r.symbol for r in got.collect()) == ["0700", "0700"]


def test_only_asked_columns_wait_in_the_context_join(spark, monkeypatch):
    from tradelake.plans import registry
    write, seen = registry.P.write_append, []
    monkeypatch.setattr(registry.P, "write_append", lambda df, *a, **k: (seen.append(df.columns), write(df, *a, **k))[1])
    got = registry.q_stream_whale_context(spark, SF_SMALL)
    assert len(seen) == 3 and all(c == got.columns for c in seen)
