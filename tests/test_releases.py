"""Publication by one switch, and serving reads of the newest periods."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import MS, bronze_rows, trade
from tradelake.plans import serving as S
from tradelake.plans.build import BuildFailed, ChecksFailed, scheduled_run
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.session import new_scratch_path
from tradelake.sources import releases as L

DAY_MS = 86_400_000


def rows(df):
    return sorted(map(str, df.collect()))


def feed(spark, days=6, extra=()):
    """Ten trades a day of one symbol, and one with a single trade every third day."""
    out = [trade(trade_id=1000 * d + i, ms=MS + d * DAY_MS + i * 60_000, price=100.0 + d * 10 + i, qty=1000.0 + i)
           for d in range(days) for i in range(10)]
    out += [trade(symbol="ETHUSDT", trade_id=500_000 + d, ms=MS + d * DAY_MS, price=50.0, qty=2000.0) for d in range(0, days, 3)]
    return bronze_rows(spark, [*out, *extra])


def files_read(df):
    """Number of files that the executed scans of ``df`` opened."""
    df._jdf.queryExecution().executedPlan()
    df.collect()
    wait, n = [df._jdf.queryExecution().executedPlan()], 0
    while wait:
        plan = wait.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            wait.append(plan.executedPlan())
            continue
        if name == "FileSourceScanExec":
            n += plan.metrics().apply("numFiles").value()
        kids = plan.children()
        wait.extend(kids.apply(i) for i in range(kids.size()))
        if name.endswith("QueryStageExec"):
            wait.append(plan.plan())
    return n


@pytest.fixture
def releases(spark):
    return L.Releases(spark, "unit", new_scratch_path(spark, "unit-releases"))


def test_nothing_is_published_before_the_first_run(releases):
    assert releases.current() is None and releases.prune() == []
    with pytest.raises(LookupError):
        releases.table("mart_vwap")


def test_publishes_all_layers_and_views(spark, releases):
    built, report = scheduled_run(spark, feed(spark), releases, symbols=["BTCUSDT", "ETHUSDT"])
    assert report.where("status = 'fail'").count() == 0
    assert set(releases.tables()) == set(L.SPECS)
    assert rows(releases.table("stg_ohlcv").drop("period")) == rows(ohlcv(stg_trades(feed(spark))))
    assert spark.table("gold.unit_mart_vwap").count() == built.candles.count()
    assert spark.table("silver.unit_stg_trades").where("period = DATE'2024-01-02'").count() == 10


def test_a_failing_check_leaves_the_old_version(spark, releases):
    few = ("stg_ohlcv",)
    scheduled_run(spark, feed(spark, 2), releases, only=few)
    old, seen = releases.current(), rows(releases.table("stg_ohlcv"))
    bad = feed(spark, 3, [trade(trade_id=9_999_999, side="HOLD", ms=MS)])
    with pytest.raises(ChecksFailed) as failed:
        scheduled_run(spark, bad, releases, only=few)
    assert "stg_trades.accepted_values:side" in failed.value.failed
    assert releases.current() == old and rows(releases.table("stg_ohlcv")) == seen
    with pytest.raises(ChecksFailed) as failed:
        scheduled_run(spark, feed(spark, 3), releases, symbols=["BTCUSDT"], only=())
    assert "bronze_trades.accepted_values:symbol" in failed.value.failed and releases.current() == old
    scheduled_run(spark, bad, releases, only=(), tolerate=("stg_trades.accepted_values:side", "bronze_trades.accepted_values:side"))
    assert releases.current() != old


def test_a_crash_at_any_point_leaves_the_old_version(spark, releases, monkeypatch):
    few = ("stg_ohlcv",)
    scheduled_run(spark, feed(spark, 2), releases, only=few)
    old, seen = releases.current(), rows(releases.table("stg_ohlcv"))
    with pytest.raises(BuildFailed):
        scheduled_run(spark, feed(spark, 3).drop("price"), releases)
    stage = L.Releases.stage

    def breaks(self, version, name, df):
        if name == "stg_ohlcv":
            raise OSError("disk lost")
        return stage(self, version, name, df)
    monkeypatch.setattr(L.Releases, "stage", breaks)
    with pytest.raises(BuildFailed):
        scheduled_run(spark, feed(spark, 3), releases, only=few)
    monkeypatch.setattr(L.Releases, "stage", stage)
    monkeypatch.setattr(L.Releases, "publish", lambda self, version: (_ for _ in ()).throw(OSError("no switch")))
    with pytest.raises(OSError):
        scheduled_run(spark, feed(spark, 3), releases, only=few)
    assert releases.current() == old and rows(releases.table("stg_ohlcv")) == seen


def test_old_versions_go_and_a_reader_keeps_its_version(spark, releases):
    versions = []
    for days in (1, 2, 3):
        scheduled_run(spark, feed(spark, days), releases, keep=2, only=())
        versions.append(releases.current())
    assert releases.table("stg_trades", versions[1]).count() == 21
    assert releases.table("stg_trades").count() == 31
    assert versions[0] not in releases._names(f"{releases.root}/versions")


@pytest.fixture(scope="module")
def served(spark):
    r = L.Releases(spark, "served", new_scratch_path(spark, "served-releases"))
    return r, scheduled_run(spark, feed(spark, 9), r)[0]


@pytest.mark.parametrize("symbol,n,files", [("BTCUSDT", 10, 1), ("BTCUSDT", 11, 2), ("ETHUSDT", 2, 2), ("ETHUSDT", 99, 3),
                                            ("NONE", 5, 0)])
def test_newest_rows_read_only_the_days_they_need(served, symbol, n, files):
    r, built = served
    part = L.newest(r, "stg_ohlcv", n, symbol)
    assert rows(S.last_candles(part, symbol, n)) == rows(S.last_candles(built.candles, symbol, n))
    assert files_read(part) <= files


def test_newest_over_all_symbols_and_under_a_condition(served):
    r, built = served
    assert rows(S.vol_compare(L.newest(r, "mart_volatility", 25), 25)) == rows(S.vol_compare(built.mart_volatility, 25))
    for bound, n in ((100_000.0, 3), (170_000.0, 40), (1e12, 5)):
        part = L.newest(r, "mart_whale_trades", n, keep=F.col("volume_usd") >= bound)
        assert rows(S.whales_recent(part, bound, n)) == rows(S.whales_recent(built.mart_whale_trades, bound, n))


def test_newest_of_each_symbol_and_last_hours(served):
    r, built = served
    assert rows(S.vol_compare_per_symbol(L.newest_of_each(r, "mart_volatility", 2), 2)) == \
        rows(S.vol_compare_per_symbol(built.mart_volatility, 2))
    assert rows(S.kpi(L.since_newest(r, "stg_ohlcv", 1), hours=24)) == rows(S.kpi(built.candles, hours=24))


def test_largest_reads_the_periods_with_the_largest_maxima(served):
    r, built = served
    for k in (1, 5, 30):
        part = L.largest(r, "mart_whale_trades", k)
        assert rows(S.top_whales(part, k)) == rows(S.top_whales(built.mart_whale_trades, k))
    assert files_read(L.largest(r, "mart_whale_trades", 1)) == 1


def test_month_periods_and_empty_layers(spark):
    r = L.Releases(spark, "monthly", new_scratch_path(spark, "monthly"), "month")
    quiet = bronze_rows(spark, [trade(trade_id=i, ms=MS + i * 20 * DAY_MS, qty=0.001) for i in range(4)])
    built, _ = scheduled_run(spark, quiet, r, only=("stg_ohlcv", "mart_whale_trades"))
    assert r.table("mart_whale_trades").count() == 0 == spark.table("gold.monthly_mart_whale_trades").count()
    assert S.top_whales(L.largest(r, "mart_whale_trades", 3), 3).count() == 0
    assert rows(S.kpi(L.since_newest(r, "stg_ohlcv", 1), hours=24)) == rows(S.kpi(built.candles, hours=24))
    assert r.table("stg_ohlcv").select("period").distinct().count() == 3
