"""Incremental dedup against a bucketed history, and whales with the closed hour's context."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import MS, bronze_rows, trade
from tradelake.operators.silver import dedup_trades, stg_trades
from tradelake.operators.whales import hourly_context, whale_base, with_hour
from tradelake.session import new_scratch_path
from tradelake.sources.history import TradeHistory
from tradelake.streaming import jobs as P

EARLY, LATE = "2024-01-01T09:00:00.000000+00:00", "2024-01-01T12:00:00.000000+00:00"


@pytest.fixture
def history(spark):
    return TradeHistory(spark, f"history_{uuid.uuid4().hex}", new_scratch_path(spark, "history"), 4)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_batches_in_any_order_give_the_full_dedup(spark, history):
    batches = [
        [trade(trade_id=i, price=10.0 + i, ingested=LATE) for i in range(40)] + [trade(trade_id=None), trade(symbol=None)],
        [trade(trade_id=i, price=20.0 + i, ingested=EARLY) for i in range(0, 40, 2)],          # better copies
        [trade(trade_id=i, price=30.0 + i, ingested=None) for i in range(50)],                 # worse copies, ten new keys
        [trade(trade_id=7, price=-1.0, ingested=EARLY, ms=MS - 1), trade(symbol="ETHUSDT", trade_id=7)] * 3,
    ]
    for b in batches:
        history.add(bronze_rows(spark, b))
    everything = bronze_rows(spark, sum(batches, []))
    assert rows(history.current()) == rows(dedup_trades(everything)) and history.current().count() == 51
    assert history.rows().count() == 40 + 20 + 10 + 2       # what was no better was not stored
    assert {r.trade_id for r in history.repeated().collect()} == {*range(0, 40, 2), 7}


def test_a_batch_that_is_replayed_adds_nothing(spark, history):
    b = bronze_rows(spark, [trade(trade_id=i) for i in range(20)] + [trade(trade_id=3, price=5.0)])
    history.add(b)
    once = rows(history.rows())
    history.add(b)
    history.add(bronze_rows(spark, []))
    assert rows(history.rows()) == once


def test_the_history_is_not_shuffled(spark, history):
    history.add(bronze_rows(spark, [trade(trade_id=i) for i in range(100)]))
    assert not [ln for ln in final_plan(history.current()).split("\n") if "Exchange" in ln]
    assert not [ln for ln in final_plan(history.repeated()).split("\n") if "Exchange" in ln]
    plan = final_plan(history.fresh_copies(bronze_rows(spark, [trade(trade_id=i) for i in range(50, 150)])))
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
    # both shuffles lie over the batch, none over the history
    batch, stored = plan[:plan.index("Scan ExistingRDD")], plan[plan.index("Scan ExistingRDD"):]
    assert batch.count(" Exchange ") == 2 and " Exchange " not in stored and "FileScan" in stored
    files = glob.glob(f"{history.path}/buckets-4/*.parquet")
    assert len(files) == 4                      # one for a bucket


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0].split("== Final Plan ==")[-1]


def test_a_history_found_again_by_its_folder(spark, history):
    history.add(bronze_rows(spark, [trade(trade_id=i) for i in range(20)]))
    again = TradeHistory(spark, f"history_{uuid.uuid4().hex}", history.path, 4)
    assert rows(again.current()) == rows(history.current())


def test_whales_wait_for_their_hour_and_have_its_final_totals(spark):
    hour = 3_600_000
    first = [trade(trade_id=1, price=60_000.0), trade(trade_id=2, price=10.0, ms=MS + 60_000),
             trade(symbol="ETHUSDT", trade_id=1, price=70_000.0, ms=MS + hour)]
    more = [trade(trade_id=3, price=90_000.0, ms=MS + 120_000, side="SELL"), trade(trade_id=4, price=20.0, ms=MS + 5_000)]
    clock = [trade(symbol="CLOCK", trade_id=9, ms=MS + 30 * hour)]
    too_late = [trade(trade_id=5, price=80_000.0, ms=MS + 6_000)]
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    seen = []
    for part in (first, more, clock):
        stg_trades(bronze_rows(spark, part)).coalesce(1).write.mode("append").parquet(src)
        P.write_append(P.whale_context_stream(P.silver_stream(spark, src, "3 hours"), 50_000.0), out, ck).awaitTermination()
        seen.append(spark.read.parquet(out).count())
    stg = stg_trades(bronze_rows(spark, first + more))
    want = with_hour(whale_base(stg, 50_000.0), hourly_context(stg, 50_000.0))
    assert seen == [0, 0, 3]                    # nothing before the hour is closed
    assert rows(spark.read.parquet(out).select(*want.columns)) == rows(want)
    stg_trades(bronze_rows(spark, too_late)).coalesce(1).write.mode("append").parquet(src)
    P.write_append(P.whale_context_stream(P.silver_stream(spark, src, "3 hours"), 50_000.0), out, ck).awaitTermination()
    found = spark.read.parquet(out).where(F.col("symbol") != "CLOCK")
    assert found.where("trade_id <> 5").count() == 3
    assert all(r.hour_total_trades is None for r in found.where("trade_id = 5").collect())


def context_runs(spark, runs, watermark):
    """The query of each run of the context stream and what is there after it."""
    src, out, ck = (new_scratch_path(spark, n) for n in ("s", "o", "c"))
    seen = []
    for part in runs:
        stg_trades(bronze_rows(spark, part)).coalesce(1).write.mode("append").parquet(src)
        q = P.write_append(P.whale_context_stream(P.silver_stream(spark, src, watermark), 50_000.0), out, ck)
        q.awaitTermination()
        seen.append((q, spark.read.parquet(out).where(F.col("symbol") != "CLOCK")))
    return seen


def test_whales_of_an_hour_wait_in_few_rows(spark):
    trades = [trade(trade_id=i, price=50_000.0 + i, ms=MS + i * 6_000) for i in range(1, 1_200)]     # two hours
    clock = [trade(symbol="CLOCK", trade_id=9, ms=MS + 30 * 3_600_000)]
    (q, _), (_, found) = context_runs(spark, [trades, clock], "3 hours")
    waiting = [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"] if "Join" in o["operatorName"]]
    assert 0 < max(waiting) < 20
    stg = stg_trades(bronze_rows(spark, trades))
    want = with_hour(whale_base(stg, 50_000.0), hourly_context(stg, 50_000.0))
    assert found.columns == whale_base(stg, 50_000.0).columns + [c for c in want.columns if c.startswith(("hour_", "pct_"))]
    assert rows(found.select(*want.columns)) == rows(want) and found.count() == 1_199


def test_late_whales_have_the_totals_of_an_open_hour_or_none(spark):
    minute = 60_000
    runs = [[trade(trade_id=1, price=60_000.0, ms=MS + 40 * minute)],
            [trade(trade_id=2, price=70_000.0, ms=MS + 10 * minute)],               # behind the watermark, 30 minutes past
            [trade(symbol="CLOCK", trade_id=9, ms=MS + 300 * minute)],
            [trade(trade_id=3, price=80_000.0, ms=MS + minute)]]
    found = [sorted((r.trade_id, r.hour_total_trades or 0) for r in f.collect()) for _, f in context_runs(spark, runs, "10 minutes")]
    assert found[2:] == [[(1, 2), (2, 2)], [(1, 2), (2, 2), (3, 0)]]


def test_packed_rows_are_bounded_and_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 3)
    monkeypatch.setattr(P, "PACK_ROWS", 40)
    data = [(None if i % 7 == 0 else f"s{i % 3}", None if i % 5 == 0 else MS + i % 4, i // 2, f"t{i}" if i % 4 else None)
            for i in range(200)] + [("s1", MS, 1, "twice")] * 8
    df = spark.createDataFrame(data, "symbol string, hour long, id int, text string").coalesce(1)
    got = P.packed(df, ["symbol", "hour"]).cache()
    assert got.columns == ["symbol", "hour", "rows"] and got.agg(F.max(F.size("rows")), F.min(F.size("rows"))).first()[:] == (3, 1)
    assert got.count() < len(data)
    back = got.select("symbol", "hour", F.inline("rows"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(data, key=repr)
    assert P.packed(df.limit(0), ["symbol", "hour"]).count() == 0
