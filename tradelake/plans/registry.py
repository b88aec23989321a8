"""Registry of named queries: Spark callable + reference SQL.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the test tables; the SQL restates it over the same tables for DuckDB.
Computed columns carry the same names on both sides.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import round_half_away
from tradelake.operators import candle_state as CS
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import dedup_trades, stg_trades
from tradelake.operators import volatility as vol
from tradelake.operators import vwap
from tradelake.operators import whales
from tradelake.plans import oracle as O
from tradelake.plans.build import materialize, scheduled_run
from tradelake.session import scratch_path
from tradelake.sources import releases as L
from tradelake.sources.adapters import event_trades, lineitem_trades
from tradelake.sources.releases import Releases


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn
    return deco


WHALE_THRESHOLD = 50_000.0


# ---- shared inputs ------------------------------------------------------------

def cut(df: DataFrame) -> DataFrame:
    """Write an intermediate as Parquet in the shared checkpoint folder and
    read it back.

    Used where one intermediate feeds several branches of a plan (candles
    feed the row numbering, the rolling windows and the hourly roll-up;
    cleaned trades feed hourly totals, whale ranks and whale summaries):
    the branches prune columns differently, so Spark cannot reuse one
    exchange for them and would recompute trades -> candles per branch.
    Parquet (rather than an RDD checkpoint) keeps column pruning, filter
    pushdown and size statistics for the readers.
    """
    return materialize(df, df.sparkSession, "shared")


def events_stg(spark, sf):
    return stg_trades(event_trades(spark, sf))


def events_candles(spark, sf, interval="1 minute"):
    return ohlcv(events_stg(spark, sf), interval)


def shared_candles(spark, sf):
    return cut(events_candles(spark, sf))


def lineitem_stg(spark, sf):
    return stg_trades(lineitem_trades(spark, sf))


def whale_mart(spark, sf):
    stg = cut(lineitem_stg(spark, sf))
    return whales.mart_whale_trades(stg, WHALE_THRESHOLD, context=cut(whales.hourly_context(stg, WHALE_THRESHOLD)))


def vwap_mart(spark, sf):
    return vwap.mart_vwap(shared_candles(spark, sf))


def volatility_mart(spark, sf):
    return vol.mart_volatility(shared_candles(spark, sf))


def published(spark, sf, feed):
    """The releases of a feed's stand-in with a published build of the input files as
    they are now: built, checked and switched by the first query that needs it, then
    read by all panels, as a scheduled run and its readers do."""
    source, trades, grain, only = {
        "events": ("events", event_trades, "day", None),
        "lineitem": ("lineitem", lineitem_trades, "month", ("mart_whale_trades",)),     # seven years, few trades a day
    }[feed]
    files = sorted(spark.read.parquet(f"{sf.rstrip('/')}/{source}.parquet").inputFiles())
    run = spark.sparkContext.applicationId      # releases of another run may come from other code
    root = scratch_path(spark, "releases", run, f"{feed}-{file_state(spark, files)}")
    releases = Releases(spark, feed, root, grain)
    if releases.current() is None:
        # ids repeat across the stand-in's symbols, and replays are part of it
        scheduled_run(spark, trades(spark, sf), releases, only=only, tolerate=(
            "bronze_trades.unique:trade_id", "mart_whale_trades.unique:trade_id",
            "bronze_trades.not_null:quantity", "bronze_trades.not_null:price"))
    return releases


def file_state(spark, files):
    """Hash of names, lengths and times of files."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    seen = []
    for f in files:
        s = path(f).getFileSystem(conf).getFileStatus(path(f))
        seen.append(f"{f}|{s.getLen()}|{s.getModificationTime()}")
    return hashlib.sha256("\n".join(seen).encode()).hexdigest()[:16]


W = O.with_ctes


# ---- silver -------------------------------------------------------------------

@register("dedup_trades", W(O.silver_ctes("lineitem")[:2], "select * from deduped"))
def q_dedup_trades(spark, sf):
    return dedup_trades(lineitem_trades(spark, sf))


@register("stg_trades", W(O.silver_ctes("lineitem"), "select * from stg_trades"))
def q_stg_trades(spark, sf):
    return lineitem_stg(spark, sf)


@register("ohlcv_1min", W(O.candle_ctes("minute"), "select * from candles"))
def q_ohlcv_1min(spark, sf):
    return events_candles(spark, sf)


@register("ohlcv_15min", W(O.candle_ctes("15 minutes"), "select * from candles"))
def q_ohlcv_15min(spark, sf):
    return events_candles(spark, sf, "15 minutes")


WIDTHS_SQL = " union all ".join(f"select '{w}' as width, * from by_{w.replace(' ', '_')}" for w in CS.WIDTHS)


@register("ohlcv_widths", W(O.silver_ctes() + [
    (f"by_{w.replace(' ', '_')}", O.OHLCV.format(src="stg_trades", bucket=f"time_bucket(interval '{w}', traded_at)"))
    for w in CS.WIDTHS], WIDTHS_SQL), note="every width from the minute states: one scan, one shuffle")
def q_ohlcv_widths(spark, sf):
    return CS.all_widths(cut(CS.candle_states(events_stg(spark, sf))))


@register("ohlcv_merged_states", W(O.candle_ctes(), "select * from candles"),
          note="states of four arbitrary parts of the trades, stored and merged")
def q_ohlcv_merged_states(spark, sf):
    stg = cut(events_stg(spark, sf))
    part = F.pmod(F.xxhash64("trade_id"), F.lit(4))
    stored = None
    for i in range(4):      # as batches arrive: each is merged into what is stored
        new = CS.candle_states(stg.where(part == i))
        stored = cut(new if stored is None else CS.merge_states(stored, new))
    return CS.finished(stored)


@register("ohlcv_1h", W(O.candle_ctes("hour"), "select * from candles"))
def q_ohlcv_1h(spark, sf):
    return events_candles(spark, sf, "1 hour")


# ---- gold: vwap -----------------------------------------------------------------

@register("hourly_vwap", W(O.vwap_ctes(), "select * from hourly_vwap"))
def q_hourly_vwap(spark, sf):
    return vwap.hourly_vwap(events_candles(spark, sf))


@register("rolling_vwap", W(O.vwap_ctes(), "select * from rolling_vwap"))
def q_rolling_vwap(spark, sf):
    return vwap.rolling_vwap(shared_candles(spark, sf))


@register("rolling_vwap_range", W(O.candle_ctes(), """
  select symbol, candle_time, close,
         round(cast(sum(cast(volume_usd as decimal(38,2))) over w as double)
               / nullif(cast(sum(cast(volume as decimal(38,8))) over w as double), 0), 6) as vwap_30min_range
  from candles
  window w as (partition by symbol order by candle_time
               range between interval 29 minutes preceding and current row)"""))
def q_rolling_vwap_range(spark, sf):
    return vwap.rolling_vwap_range(events_candles(spark, sf), 30)


@register("mart_vwap", W(O.vwap_ctes(), "select * from mart_vwap"))
def q_mart_vwap(spark, sf):
    return vwap_mart(spark, sf)


# ---- gold: volatility -------------------------------------------------------------

@register("log_returns", W(O.volatility_ctes(), """
  select symbol, candle_time, close, prev_close, log_return, true_range from returns"""))
def q_log_returns(spark, sf):
    return vol.log_returns(shared_candles(spark, sf))


@register("sma_20", W(O.volatility_ctes(), "select symbol, candle_time, close, sma_20 from mart_volatility"))
def q_sma_20(spark, sf):
    return volatility_mart(spark, sf).select("symbol", "candle_time", "close", "sma_20")


BOLLINGER_COLS = ["symbol", "candle_time", "close", "sma_20", "std_20", "bb_upper",
                  "bb_lower", "bb_bandwidth", "pct_b"]


@register("bollinger", W(O.volatility_ctes(), f"select {', '.join(BOLLINGER_COLS)} from mart_volatility"))
def q_bollinger(spark, sf):
    return volatility_mart(spark, sf).select(*BOLLINGER_COLS)


@register("realized_vol", W(O.volatility_ctes(), """
  select symbol, candle_time, log_return, realized_vol_pct, annualized_vol from mart_volatility"""))
def q_realized_vol(spark, sf):
    return volatility_mart(spark, sf).select("symbol", "candle_time", "log_return",
                                             "realized_vol_pct", "annualized_vol")


@register("atr_14", W(O.volatility_ctes(), "select symbol, candle_time, atr_14 from mart_volatility"))
def q_atr_14(spark, sf):
    return volatility_mart(spark, sf).select("symbol", "candle_time", "atr_14")


@register("mart_volatility", W(O.volatility_ctes(), "select * from mart_volatility"))
def q_mart_volatility(spark, sf):
    return volatility_mart(spark, sf)


@register("cvd", W(O.candle_ctes(), """
  select symbol, candle_time, volume_delta,
         cast(sum(cast(volume_delta as decimal(38,8))) over (
              partition by symbol order by candle_time
              rows between unbounded preceding and current row) as double) as cvd
  from candles"""))
def q_cvd(spark, sf):
    return vol.cvd(shared_candles(spark, sf))


# ---- gold: whales ------------------------------------------------------------------

WT = O.whale_ctes(WHALE_THRESHOLD)


@register("hourly_market", W(WT, "select * from hourly_market"))
def q_hourly_market(spark, sf):
    return whales.hourly_market(lineitem_stg(spark, sf))


@register("whale_filter", W(WT, f"select * from stg_trades where volume_usd >= {WHALE_THRESHOLD}"))
def q_whale_filter(spark, sf):
    return whales.whale_filter(lineitem_stg(spark, sf), WHALE_THRESHOLD)


@register("whale_tier", W(WT, "select symbol, trade_id, volume_usd, whale_tier from whale_trades"))
def q_whale_tier(spark, sf):
    return whales.whale_base(lineitem_stg(spark, sf), WHALE_THRESHOLD).select("symbol", "trade_id", "volume_usd", "whale_tier")


@register("whale_context", W(WT, """
  select trade_id, symbol, hour, volume_usd, hour_total_volume_usd, hour_total_trades, pct_of_hour_volume
  from whale_trades"""))
def q_whale_context(spark, sf):
    stg = cut(lineitem_stg(spark, sf))
    base = whales.whale_base(stg, WHALE_THRESHOLD)
    return whales.with_hour(base, cut(whales.hourly_context(stg, WHALE_THRESHOLD))).select(
        "trade_id", "symbol", "hour", "volume_usd", "hour_total_volume_usd", "hour_total_trades", "pct_of_hour_volume")


@register("whale_rank", W(WT, "select trade_id, symbol, hour, volume_usd, rank_in_hour from whale_trades"))
def q_whale_rank(spark, sf):
    base = cut(whales.whale_base(lineitem_stg(spark, sf), WHALE_THRESHOLD))
    return whales.rank_desc(base, ["symbol", "hour"], "volume_usd", "rank_in_hour", "split").select(
        "trade_id", "symbol", "hour", "volume_usd", "rank_in_hour")


@register("hourly_whale_summary", W(WT, "select * from hourly_whale_summary"))
def q_hourly_whale_summary(spark, sf):
    return whales.hourly_whale_summary(whales.whale_base(lineitem_stg(spark, sf), WHALE_THRESHOLD))


@register("mart_whale_trades", W(WT, "select * from mart_whale_trades"))
def q_mart_whale_trades(spark, sf):
    return whale_mart(spark, sf)


# ---- serving --------------------------------------------------------------------

from tradelake.plans import serving as S  # noqa: E402
from tradelake.sources.adapters import EVENT_SYMBOLS  # noqa: E402

PANEL_SYMBOL = "CLICK"     # the symbol the single-symbol panels show
PANEL_CANDLES = 120        # default panel length (candles)


def _xs(col, scale, over=""):
    o = f" over {over}" if over else ""
    return f"cast(sum(cast({col} as decimal(38,{scale}))){o} as double)"


EV = O.merge_ctes(O.vwap_ctes(), O.volatility_ctes())
RECENT_SQL = "traded_at desc, symbol asc, trade_id asc"


@register("overview", W(O.silver_ctes(), f"""
  select symbol, n as total_trades, round(cheapest, 2) as price_min, round(dearest, 2) as price_max,
         round(prices / nullif(priced, 0), 2) as price_avg, round(money / 1e6, 2) as total_volume_m,
         first_trade, last_trade
  from (select symbol, count(*) as n, min(price) as cheapest, max(price) as dearest, count(price) as priced,
               {_xs('price', 10)} as prices, {_xs('volume_usd', 6)} as money,
               min(traded_at) as first_trade, max(traded_at) as last_trade
        from stg_trades group by all)
  order by total_volume_m desc, symbol"""))
def q_overview(spark, sf):
    return S.overview(events_stg(spark, sf))


def _kpi_sql(source: str = "candles") -> str:
    return f"""
  select symbol, last_price, first_price, high_24h, low_24h, volume_m, last_vwap,
         (last_price - first_price) / nullif(first_price, 0) * 100.0 as pct_change
  from (select symbol, arg_min(close, candle_time) as first_price, arg_max(close, candle_time) as last_price,
               arg_max(vwap, candle_time) as last_vwap, max(high) as high_24h, min(low) as low_24h,
               round({_xs('volume_usd', 2)} / 1e6, 2) as volume_m
        from {source} group by all)"""


@register("kpi", W(O.candle_ctes(), _kpi_sql()))
def q_kpi(spark, sf):
    return S.kpi(events_candles(spark, sf))


KPI_24H = """
  select c.* from candles c join (select symbol, max(candle_time) as newest from candles group by symbol) n using (symbol)
  where c.candle_time > n.newest - interval 24 hours"""


@register("kpi_24h", W(O.candle_ctes() + [("recent", KPI_24H)], _kpi_sql("recent")))
def q_kpi_24h(spark, sf):
    return S.kpi(L.since_newest(published(spark, sf, "events"), "stg_ohlcv", 1), hours=24)


@register("last_candles", W(O.candle_ctes(), f"""
  select candle_time, open, high, low, close, volume_usd, vwap, volume_delta,
         buy_volume, sell_volume, close >= open as is_bull
  from candles where symbol = '{PANEL_SYMBOL}'
  order by candle_time desc limit {PANEL_CANDLES}"""))
def q_last_candles(spark, sf):
    return S.last_candles(L.newest(published(spark, sf, "events"), "stg_ohlcv", PANEL_CANDLES, PANEL_SYMBOL), PANEL_SYMBOL,
                          PANEL_CANDLES)


@register("candle_shape", W(O.candle_ctes(), """
  select symbol, candle_time, close >= open as is_bull, abs(close - open) as body,
         least(open, close) as body_base
  from candles"""))
def q_candle_shape(spark, sf):
    return S.candle_shape(events_candles(spark, sf))


@register("bollinger_panel", W(EV, f"""
  select candle_time, close, sma_20, bb_upper, bb_lower, pct_b, realized_vol_pct, bb_bandwidth
  from mart_volatility where symbol = '{PANEL_SYMBOL}'
  order by candle_time desc limit {PANEL_CANDLES}"""))
def q_bollinger_panel(spark, sf):
    return S.bollinger_panel(L.newest(published(spark, sf, "events"), "mart_volatility", PANEL_CANDLES, PANEL_SYMBOL),
                             PANEL_SYMBOL, PANEL_CANDLES)


@register("vwap_deviation_split", W(EV, f"""
  select candle_time, close, vwap_30min, vwap_60min, price_vs_vwap, hourly_vwap,
         case when price_vs_vwap > 0 then price_vs_vwap when price_vs_vwap is not null then 0.0 end as above_vwap,
         case when price_vs_vwap < 0 then price_vs_vwap when price_vs_vwap is not null then 0.0 end as below_vwap
  from mart_vwap where symbol = '{PANEL_SYMBOL}'
  order by candle_time desc limit {PANEL_CANDLES}"""))
def q_vwap_deviation_split(spark, sf):
    return S.vwap_deviation_split(L.newest(published(spark, sf, "events"), "mart_vwap", PANEL_CANDLES, PANEL_SYMBOL),
                                  PANEL_SYMBOL, PANEL_CANDLES)


@register("vwap_last30", W(EV, f"""
  select candle_time, vwap_30min, close from mart_vwap where symbol = '{PANEL_SYMBOL}'
  order by candle_time desc limit 30"""))
def q_vwap_last30(spark, sf):
    return S.vwap_last30(L.newest(published(spark, sf, "events"), "mart_vwap", 30, PANEL_SYMBOL), PANEL_SYMBOL)


@register("whales_recent", W(WT, f"""
  select traded_at, symbol, trade_id, price, volume_usd, side, whale_tier, pct_of_hour_volume, rank_in_hour
  from mart_whale_trades where volume_usd >= 100000.0
  order by {RECENT_SQL} limit 100"""))
def q_whales_recent(spark, sf):
    return S.whales_recent(L.newest(published(spark, sf, "lineitem"), "mart_whale_trades", 100,
                                    keep=F.col("volume_usd") >= 100_000.0), 100_000.0, 100)


@register("top_whales", W(WT, f"""
  select symbol, traded_at, price, volume_usd, side from mart_whale_trades
  order by volume_usd desc, {RECENT_SQL} limit 5"""))
def q_top_whales(spark, sf):
    return S.top_whales(L.largest(published(spark, sf, "lineitem"), "mart_whale_trades", 5), 5)


@register("top10_recent_whales", W(WT, f"""
  select traded_at, symbol, trade_id, price, volume_usd, side, whale_tier, pct_of_hour_volume
  from (select * from mart_whale_trades order by {RECENT_SQL} limit 200)
  order by volume_usd desc, {RECENT_SQL} limit 10"""))
def q_top10_recent_whales(spark, sf):
    return S.top10_recent_whales(L.newest(published(spark, sf, "lineitem"), "mart_whale_trades", 200), 200, 10)


@register("whale_tier_crosstab", W(WT, f"""
  select t.whale_tier, t.tier_order,
         coalesce(c.BUY, 0) as BUY, coalesce(c.SELL, 0) as SELL
  from (values ('small', 0), ('medium', 1), ('large', 2), ('mega', 3)) t(whale_tier, tier_order)
  left join (select whale_tier, count(*) filter (where side = 'BUY') as BUY,
                    count(*) filter (where side = 'SELL') as SELL
             from (select * from mart_whale_trades order by {RECENT_SQL} limit 200)
             group by whale_tier) c
  on t.whale_tier = c.whale_tier"""))
def q_whale_tier_crosstab(spark, sf):
    return S.whale_tier_crosstab(spark, L.newest(published(spark, sf, "lineitem"), "mart_whale_trades", 200), 200)


VOL_COMPARE_SQL = """(select symbol, candle_time, realized_vol_pct, annualized_vol, close
   from mart_volatility order by candle_time desc, symbol asc limit 360)"""


@register("vol_compare", W(EV, f"select * from {VOL_COMPARE_SQL}"))
def q_vol_compare(spark, sf):
    return S.vol_compare(L.newest(published(spark, sf, "events"), "mart_volatility", 360), 360)


@register("normalized_price", W(EV, f"""
  select symbol, candle_time, close,
         close / first_value(close) over (partition by symbol order by candle_time) * 100.0 as normalized_price
  from {VOL_COMPARE_SQL}"""))
def q_normalized_price(spark, sf):
    return S.normalized_price(L.newest(published(spark, sf, "events"), "mart_volatility", 360), 360)


@register("vol_compare_per_symbol", W(EV, """
  select symbol, candle_time, realized_vol_pct, annualized_vol, close from (
    select *, row_number() over (partition by symbol order by candle_time desc) as rn
    from mart_volatility) where rn <= 120"""))
def q_vol_compare_per_symbol(spark, sf):
    return S.vol_compare_per_symbol(L.newest_of_each(published(spark, sf, "events"), "mart_volatility", 120), 120)


BUY_PRESSURE_SQL = f"""
  select symbol, hour, round(bought / nullif(money, 0) * 100, 1) as buy_pct
  from (select symbol, date_trunc('hour', traded_at) as hour, {_xs('volume_usd', 6)} as money,
               {_xs("if(side = 'BUY', volume_usd, null)", 6)} as bought
        from stg_trades group by all)"""


@register("buy_pressure", W(O.silver_ctes(), BUY_PRESSURE_SQL))
def q_buy_pressure(spark, sf):
    return S.buy_pressure(events_stg(spark, sf))


@register("buy_pressure_pivot", W(O.silver_ctes() + [("bp", BUY_PRESSURE_SQL)],
                                  "select hour, " + ", ".join(
                                      f"max(case when symbol = '{s}' then buy_pct end) as {s}"
                                      for s in EVENT_SYMBOLS)
                                  + ", strftime(hour, '%H:%M') as hour_label from bp group by hour"))
def q_buy_pressure_pivot(spark, sf):
    return S.buy_pressure_pivot(events_stg(spark, sf), EVENT_SYMBOLS)


@register("hourly_volatility", W(EV, f"""
  select symbol, date_trunc('hour', candle_time) as hour,
         round({_xs('realized_vol_pct', 6)} / nullif(count(realized_vol_pct), 0), 6) as volatility_pct,
         round({_xs('annualized_vol', 6)} / nullif(count(annualized_vol), 0), 6) as annualized_vol_pct
  from mart_volatility group by 1, 2"""))
def q_hourly_volatility(spark, sf):
    return S.hourly_volatility(volatility_mart(spark, sf))


@register("pct_b_signal", W(EV, """
  select symbol, candle_time, close, pct_b,
         case when pct_b > 1 then 'overbought' when pct_b < 0 then 'oversold'
              when pct_b is not null then 'neutral' end as signal
  from mart_volatility"""))
def q_pct_b_signal(spark, sf):
    return S.pct_b_signal(volatility_mart(spark, sf))


# ---- data quality ------------------------------------------------------------------

from tradelake.functions import FEED_SYMBOLS, SIDES, TIER_ORDER  # noqa: E402
from tradelake.operators import quality as Q  # noqa: E402

DQ_CHECKS = {
    # table: (columns that must be non-NULL)
    "bronze_trades": ["trade_id", "symbol", "price", "quantity", "timestamp", "ingested_at"],
    "stg_trades": ["trade_id", "symbol", "price", "quantity", "volume_usd", "side", "traded_at", "ingested_at"],
    "stg_ohlcv_1min": ["symbol", "candle_time", "open", "high", "low", "close", "volume_usd", "vwap", "volume_delta"],
    "mart_vwap": ["symbol", "candle_time", "vwap_30min", "vwap_60min", "price_vs_vwap"],
    "mart_volatility": ["symbol", "candle_time"],
    "mart_whale_trades": ["trade_id", "symbol", "traded_at", "volume_usd"],
}
DQ_SQL_TABLE = {"bronze_trades": "bronze", "stg_trades": "stg_trades", "stg_ohlcv_1min": "candles",
                "mart_vwap": "mart_vwap", "mart_volatility": "mart_volatility",
                "mart_whale_trades": "l_mart_whale_trades"}
DQ_CTES = O.merge_ctes(EV, O.whale_ctes(WHALE_THRESHOLD, p="l_"))


def _dq_tables(spark, sf):
    """Bronze as it comes, the other layers as they were published."""
    events, whale_feed = published(spark, sf, "events"), published(spark, sf, "lineitem")
    return {"bronze_trades": event_trades(spark, sf), "stg_trades": events.table("stg_trades"),
            "stg_ohlcv_1min": events.table("stg_ohlcv"), "mart_vwap": events.table("mart_vwap"),
            "mart_volatility": events.table("mart_volatility"),
            "mart_whale_trades": whale_feed.table("mart_whale_trades")}


def _not_null_sql():
    parts = []
    for table, cols in DQ_CHECKS.items():
        src = DQ_SQL_TABLE[table]
        sel = ", ".join(f"count(*) filter (where \"{c}\" is null) as \"{c}\"" for c in cols)
        unp = " union all ".join(
            f"select '{table}' as table_name, '{c}' as column_name, cast(\"{c}\" as bigint) as failures from t_{table}"
            for c in cols)
        parts.append((f"t_{table}", f"select {sel} from {src}"))
        parts.append((f"u_{table}", unp))
    final = " union all ".join(
        f"select *, case when failures = 0 then 'pass' else 'fail' end as status from u_{t}" for t in DQ_CHECKS)
    return W(DQ_CTES + parts, final)


@register("dq_not_null", _not_null_sql())
def q_dq_not_null(spark, sf):
    t = _dq_tables(spark, sf)
    return Q.union_all([Q.not_null(t[name], name, cols) for name, cols in DQ_CHECKS.items()])


@register("dq_unique", W(O.whale_ctes(WHALE_THRESHOLD, p="l_"), """
  select 'bronze_trades' as table_name, 'symbol,trade_id' as key_columns,
         concat_ws('|', symbol, cast(trade_id as varchar)) as key_value, count(*) as n
  from l_bronze group by symbol, trade_id having count(*) > 1
  union all
  select 'stg_trades', 'symbol,trade_id', concat_ws('|', symbol, cast(trade_id as varchar)), count(*)
  from l_stg_trades group by symbol, trade_id having count(*) > 1
  union all
  select 'stg_trades', 'trade_id', cast(trade_id as varchar), count(*)
  from l_stg_trades group by trade_id having count(*) > 1
  union all
  select 'bronze_trades', 'trade_id', cast(trade_id as varchar), count(*)
  from l_bronze group by trade_id having count(*) > 1
  union all
  select 'mart_whale_trades', 'trade_id', cast(trade_id as varchar), count(*)
  from l_mart_whale_trades group by trade_id having count(*) > 1"""))
def q_dq_unique(spark, sf):
    bronze = lineitem_trades(spark, sf)
    key = ["symbol", "trade_id"]
    loaded = cut(Q.key_counts(bronze, key))
    # the mart has one row for each whale trade, so its ids are those of the filter
    kept = cut(Q.key_counts(stg_trades(bronze), key, whales=F.col("volume_usd") >= F.lit(WHALE_THRESHOLD)))
    return Q.union_all([
        Q.repeated(loaded, "bronze_trades", key),
        Q.repeated(loaded, "bronze_trades", ["trade_id"]),
        Q.repeated(kept, "stg_trades", key),
        Q.repeated(kept, "stg_trades", ["trade_id"]),   # the id-only form; ids repeat across symbols
        Q.repeated(kept, "mart_whale_trades", ["trade_id"], "whales"),
    ])


def _in_list(values):
    return ", ".join(f"'{v}'" for v in values)


@register("dq_accepted_values", W(O.merge_ctes(O.silver_ctes(), O.whale_ctes(WHALE_THRESHOLD, p="l_")), f"""
  select 'stg_trades' as table_name, 'symbol' as column_name, cast(symbol as varchar) as value, count(*) as n
  from stg_trades where symbol not in ({_in_list(FEED_SYMBOLS)}) group by symbol
  union all
  select 'stg_trades', 'side', side, count(*) from stg_trades
  where side not in ({_in_list(SIDES)}) group by side
  union all
  select 'mart_whale_trades', 'whale_tier', whale_tier, count(*) from l_mart_whale_trades
  where whale_tier not in ({_in_list(TIER_ORDER)}) group by whale_tier
  union all
  select 'mart_whale_trades', 'side', side, count(*) from l_mart_whale_trades
  where side not in ({_in_list(SIDES)}) group by side
  union all
  select 'bronze_trades', 'symbol', symbol, count(*) from bronze
  where symbol not in ({_in_list(FEED_SYMBOLS)}) group by symbol
  union all
  select 'bronze_trades', 'side', side, count(*) from bronze
  where side not in ({_in_list(SIDES)}) group by side"""))
def q_dq_accepted_values(spark, sf):
    stg, bronze = cut(events_stg(spark, sf)), event_trades(spark, sf)
    big = whales.whale_base(lineitem_stg(spark, sf), WHALE_THRESHOLD)   # tier and side as the mart has them
    return Q.union_all([
        Q.accepted_values(bronze, "bronze_trades", "symbol", FEED_SYMBOLS),
        Q.accepted_values(bronze, "bronze_trades", "side", SIDES),
        Q.accepted_values(big, "mart_whale_trades", "side", SIDES),
        Q.accepted_values(big, "mart_whale_trades", "whale_tier", TIER_ORDER),
        Q.accepted_values(stg, "stg_trades", "symbol", FEED_SYMBOLS),
        Q.accepted_values(stg, "stg_trades", "side", SIDES),
    ])


FRESHNESS_AS_OF = "2024-01-31 00:00:00"


@register("dq_freshness", W(O.silver_ctes(), f"""
  select 'bronze_trades' as table_name, symbol, max_loaded_at, as_of, age_minutes,
         case when age_minutes > 30 then 'error' when age_minutes > 10 then 'warn' else 'pass' end as status
  from (select symbol, max(try_cast(ingested_at as timestamp)) as max_loaded_at,
               timestamp '{FRESHNESS_AS_OF}' as as_of,
               (epoch_us(timestamp '{FRESHNESS_AS_OF}') - epoch_us(max(try_cast(ingested_at as timestamp)))) / 60e6 as age_minutes
        from bronze group by symbol)"""))
def q_dq_freshness(spark, sf):
    bronze = event_trades(spark, sf)
    return Q.freshness(bronze, "bronze_trades", F.col("ingested_at").try_cast("timestamp"),
                       F.lit(FRESHNESS_AS_OF).cast("timestamp"), by=["symbol"])


@register("dq_range", W(O.merge_ctes(O.silver_ctes(), O.whale_ctes(WHALE_THRESHOLD, p="l_")), f"""
  select 'stg_trades' as table_name, check_name, failures,
         case when failures = 0 then 'pass' else 'fail' end as status
  from (select 'price_positive' as check_name, count(*) filter (where not (price > 0)) as failures from stg_trades
        union all
        select 'quantity_positive', count(*) filter (where not (quantity > 0)) from stg_trades)
  union all
  select 'bronze_trades', check_name, failures, case when failures = 0 then 'pass' else 'fail' end
  from (select 'price_positive' as check_name, count(*) filter (where not (price > 0)) as failures from bronze
        union all
        select 'quantity_positive', count(*) filter (where not (quantity > 0)) from bronze)
  union all
  select 'mart_whale_trades', 'volume_at_least_threshold', failures,
         case when failures = 0 then 'pass' else 'fail' end
  from (select count(*) filter (where not (volume_usd >= {WHALE_THRESHOLD})) as failures from l_mart_whale_trades)"""))
def q_dq_range(spark, sf):
    bronze = event_trades(spark, sf)
    stg = stg_trades(bronze)
    positive = {"price_positive": F.col("price") > 0, "quantity_positive": F.col("quantity") > 0}
    return Q.union_all([
        Q.range_check(stg, "stg_trades", positive),
        Q.range_check(bronze, "bronze_trades", positive),
        Q.range_check(whales.whale_base(lineitem_stg(spark, sf), WHALE_THRESHOLD), "mart_whale_trades",
                      {"volume_at_least_threshold": F.col("volume_usd") >= F.lit(WHALE_THRESHOLD)}),
    ])


# ---- ingest: raw frames, Kafka framing, bronze storage ---------------------------

from tradelake.sources import bronze as B  # noqa: E402
from tradelake.sources import raw as R  # noqa: E402
from tradelake.sources.kafka import kafka_envelope  # noqa: E402
from tradelake.sources.tables import write_table  # noqa: E402
from tradelake.session import new_scratch_path  # noqa: E402

def event_frames(spark, sf):
    """Every event as a good frame, and as a damaged copy for each reject reason.  A
    small file of events makes many frames, so events are dealt to all tasks first."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    good = R.frames_from_trades(event_trades(spark, sf).repartition(tasks))
    return good.unionByName(R.damaged_frames(good))


ARRIVAL_ISO = "strftime(make_timestamp(\"timestamp\" * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
ENVELOPE_ONLY = "malformed_envelope"     # only wrapped frames (BUY) have an envelope to damage


@register("parse_raw_trades", W(O.silver_ctes(), f"""
  select event_type, symbol, trade_id, price, quantity, volume_usd, side, is_buyer, "timestamp",
         {ARRIVAL_ISO} as ingested_at
  from bronze"""))
def q_parse_raw_trades(spark, sf):
    return R.parse_raw_trades(R.frames_from_trades(event_trades(spark, sf)))


@register("parse_rejects", W(O.silver_ctes(), " union all ".join(
    f"select '{reason}' as reject_reason, count(*) as n from bronze"
    + (" where side = 'BUY'" if reason == ENVELOPE_ONLY else "") for reason in R.DAMAGES)))
def q_parse_rejects(spark, sf):
    return R.reject_counts(R.parse_rejects(event_frames(spark, sf)))


@register("kafka_envelope", W(O.silver_ctes(), """
  select lower(symbol) || '_trades' as topic, cast(trade_id as varchar) as key,
         to_json({'event_type': event_type, 'symbol': symbol, 'trade_id': trade_id, 'price': price,
                  'quantity': quantity, 'volume_usd': volume_usd, 'side': side, 'is_buyer': is_buyer,
                  'timestamp': "timestamp", 'ingested_at': ingested_at}) as value
  from bronze"""))
def q_kafka_envelope(spark, sf):
    return kafka_envelope(event_trades(spark, sf))


def written_bronze(spark, sf):
    path = new_scratch_path(spark, "bronze")
    B.write_bronze(event_trades(spark, sf), path)
    return path


BRONZE_DIRS_SQL = """
  select *, strftime(make_timestamp("timestamp" * 1000), '%Y') as year,
         strftime(make_timestamp("timestamp" * 1000), '%m') as month,
         strftime(make_timestamp("timestamp" * 1000), '%d') as day
  from bronze"""
BRONZE_CTES = O.silver_ctes() + [("bronze_dirs", BRONZE_DIRS_SQL)]


@register("bronze_roundtrip", W(BRONZE_CTES, "select * from bronze_dirs"))
def q_bronze_roundtrip(spark, sf):
    return B.read_bronze(spark, written_bronze(spark, sf))


@register("bronze_scan", W(BRONZE_CTES, "select * from bronze_dirs"))
def q_bronze_scan(spark, sf):
    B.bronze_view(spark, written_bronze(spark, sf), "trades")
    return spark.sql("SELECT * FROM trades")


PRUNE_SYMBOL, PRUNE_DAY = "CLICK", "2024-01-15"


@register("bronze_partition_prune", W(BRONZE_CTES, f"""
  select * from bronze_dirs where symbol = '{PRUNE_SYMBOL}'
  and year || '-' || month || '-' || day = '{PRUNE_DAY}'"""))
def q_bronze_partition_prune(spark, sf):
    return B.read_bronze(spark, written_bronze(spark, sf)).where(B.day_filter(PRUNE_SYMBOL, PRUNE_DAY))


RANGE_MS = (1_705_276_800_000, 1_705_276_800_000 + 36 * 3_600_000)     # 2024-01-15 00:00 to 16th 12:00


@register("bronze_range_scan", W(BRONZE_CTES, f"""
  select * from bronze_dirs where "timestamp" >= {RANGE_MS[0]} and "timestamp" < {RANGE_MS[1]}"""))
def q_bronze_range_scan(spark, sf):
    return B.read_bronze(spark, written_bronze(spark, sf)).where(B.time_range_filter(*RANGE_MS))


@register("bronze_sample", W(BRONZE_CTES, """
  select * from bronze_dirs order by symbol, year, month, day, trade_id limit 5"""))
def q_bronze_sample(spark, sf):
    return (B.read_bronze(spark, written_bronze(spark, sf))
            .orderBy("symbol", "year", "month", "day", "trade_id").limit(5))


@register("bronze_compact", W(BRONZE_CTES, "select * from bronze_dirs"))
def q_bronze_compact(spark, sf):
    return B.compact_bronze(spark, written_bronze(spark, sf), new_scratch_path(spark, "bronze_compact"))


@register("multi_source_union", W(O.merge_ctes(O.silver_ctes(), O.silver_ctes("lineitem", p="l_")),
                                  "select * from bronze union all select * from l_bronze"))
def q_multi_source_union(spark, sf):
    return event_trades(spark, sf).unionByName(lineitem_trades(spark, sf))


@register("gold_roundtrip", W(O.vwap_ctes(), "select * from mart_vwap"))
def q_gold_roundtrip(spark, sf):
    return write_table(spark, vwap_mart(spark, sf), "gold", "mart_vwap", partition_by=["symbol"])


@register("gold_partial_rebuild", W(O.vwap_ctes(), "select * from mart_vwap"),
          note="one symbol rebuilt after a whole build: the others stay")
def q_gold_partial_rebuild(spark, sf):
    mart = cut(vwap_mart(spark, sf))
    write_table(spark, mart, "gold", "mart_vwap_partial", partition_by=["symbol"])
    return write_table(spark, mart.where(F.col("symbol") == PANEL_SYMBOL), "gold", "mart_vwap_partial",
                       partition_by=["symbol"])


@register("gold_published", W(O.vwap_ctes(), "select * from mart_vwap"),
          note="staged, checked, switched; read as the published version")
def q_gold_published(spark, sf):
    return published(spark, sf, "events").table("mart_vwap").drop(L.PERIOD)


@register("silver_stg_trades", W(O.silver_ctes(), "select * from stg_trades"))
def q_silver_stg_trades(spark, sf):
    return write_table(spark, events_stg(spark, sf), "silver", "stg_trades", partition_by=["symbol"])


@register("gold_mart_volatility", W(O.volatility_ctes(), "select * from mart_volatility"))
def q_gold_mart_volatility(spark, sf):
    return write_table(spark, volatility_mart(spark, sf), "gold", "mart_volatility", partition_by=["symbol"])


@register("gold_mart_whale_trades", W(WT, "select * from mart_whale_trades"))
def q_gold_mart_whale_trades(spark, sf):
    return write_table(spark, whale_mart(spark, sf), "gold", "mart_whale_trades", partition_by=["symbol"])


# ---- streaming (availableNow runs over files; the sink is read back) ---------------

from tradelake.streaming import jobs as P  # noqa: E402

STREAM_WATERMARK = "10 minutes"
REPLAY_WATERMARK = "31 days"     # replays are re-read up to a month later


@register("stream_ohlcv", W(O.candle_ctes(), f"""
  select * from candles
  where candle_time + interval 1 minute
        <= (select max(make_timestamp("timestamp" * 1000)) from bronze) - interval {STREAM_WATERMARK}"""),
          note="append mode: candles whose window ends after the final watermark are still open")
def q_stream_ohlcv(spark, sf):
    src, out, ck = (new_scratch_path(spark, n) for n in ("stream_src", "stream_ohlcv", "stream_ohlcv_ck"))
    event_trades(spark, sf).write.parquet(src)
    q = P.write_append(P.stream_candles(P.stream_trades(P.bronze_stream(spark, src), STREAM_WATERMARK)),
                       out, ck)
    q.awaitTermination()
    return spark.read.parquet(out).select(*ohlcv(events_stg(spark, sf)).columns)


@register("stream_hourly", W(O.vwap_ctes(), f"""
  select * from hourly_vwap
  where hour + interval 1 hour
        <= (select max(make_timestamp("timestamp" * 1000)) from bronze) - interval {STREAM_WATERMARK}"""),
          note="all measures of the hourly roll-up, in several micro-batches; append mode as above")
def q_stream_hourly(spark, sf):
    src, out, ck = (new_scratch_path(spark, n) for n in ("hourly_src", "stream_hourly", "stream_hourly_ck"))
    event_trades(spark, sf).repartitionByRange(4, "timestamp").write.parquet(src)
    candles = P.stream_candles(P.stream_trades(P.bronze_stream(spark, src), STREAM_WATERMARK), keep_window=True)
    P.write_append(P.stream_hourly(candles), out, ck).awaitTermination()
    return spark.read.parquet(out).select(*vwap.hourly_vwap(events_candles(spark, sf)).columns)


def replays(trades):
    """Copies of the BUY trades re-delivered an hour after first ingestion."""
    later = F.date_format(F.to_timestamp("ingested_at") + F.expr("INTERVAL 1 HOUR"),
                          "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (trades.where(F.col("side") == F.lit("BUY"))
            .withColumn("ingested_at", F.concat(later, F.lit("+00:00"))))


@register("stream_dedup", W(O.silver_ctes(), "select * from stg_trades"),
          note="originals in a first run, replays after a restart from the checkpoint")
def q_stream_dedup(spark, sf):
    src, out, ck = (new_scratch_path(spark, n) for n in ("dedup_src", "stream_dedup", "stream_dedup_ck"))
    trades = event_trades(spark, sf)
    trades.write.parquet(src)

    def run():
        q = P.write_append(P.stream_trades(P.bronze_stream(spark, src), REPLAY_WATERMARK), out, ck)
        q.awaitTermination()

    run()
    replays(trades).write.mode("append").parquet(src)
    run()                                   # restart: only the replay files are new
    return spark.read.parquet(out).select(*events_stg(spark, sf).columns)


from tradelake.streaming import state as ST  # noqa: E402

CLOCK = "CLOCK"     # a trade long after all others, which moves the watermark past their horizon


@register("stream_dedup_settled", W(O.silver_ctes(), "select * from stg_trades"),
          note="replays arrive first, originals after a restart; the least ingested_at wins, as in the batch")
def q_stream_dedup_settled(spark, sf):
    src, out, ck = (new_scratch_path(spark, n) for n in ("settled_src", "stream_settled", "settled_ck"))
    trades = event_trades(spark, sf)
    clock = trades.limit(1).withColumns({"symbol": F.lit(CLOCK), "timestamp": F.lit(1_735_689_600_000)})     # 2025-01-01
    for part in (replays(trades), trades, clock):
        part.select(*trades.columns).write.mode("append").parquet(src)
        P.write_append(ST.settled_trades(P.bronze_stream(spark, src), REPLAY_WATERMARK), out, ck).awaitTermination()
    return spark.read.parquet(out).select(*events_stg(spark, sf).columns)


@register("stream_whale_context", W(WT, """
  select trade_id, symbol, hour, volume_usd, hour_total_volume_usd, hour_total_trades, pct_of_hour_volume
  from whale_trades"""), note="stream-stream join; a whale is emitted when its hour is closed, across a restart")
def q_stream_whale_context(spark, sf):
    src, out, ck = (new_scratch_path(spark, n) for n in ("silver_src", "stream_context", "context_ck"))
    columns = ["trade_id", "symbol", "hour", "volume_usd", "hour_total_volume_usd", "hour_total_trades", "pct_of_hour_volume"]
    trades = cut(lineitem_stg(spark, sf))
    late = F.pmod(F.xxhash64("trade_id"), F.lit(2)) == 1        # half of every hour comes after the restart
    clock = trades.limit(1).withColumns({"symbol": F.lit(CLOCK), "traded_at": F.lit("2100-01-01").cast("timestamp")})
    for part in (trades.where(~late), trades.where(late), clock):
        part.select(*trades.columns).write.mode("append").parquet(src)
        P.write_append(P.whale_context_stream(P.silver_stream(spark, src, "3650 days"), WHALE_THRESHOLD, columns),
                       out, ck).awaitTermination()
    return spark.read.parquet(out).select(*columns)


from tradelake.sources.history import TradeHistory  # noqa: E402


@register("dedup_incremental", W(O.silver_ctes("lineitem")[:2], "select * from deduped"),
          note="three batches against a bucketed history; copies of a key are spread over the batches")
def q_dedup_incremental(spark, sf):
    path = new_scratch_path(spark, "history")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    history = TradeHistory(spark, path.rsplit("/", 1)[-1].replace("-", "_"), path, buckets)
    trades = lineitem_trades(spark, sf)
    part = F.pmod(F.xxhash64("trade_id", "price", "ingested_at"), F.lit(3))
    for i in range(3):
        history.add(trades.where(part == i))
    return history.current()


from tradelake.schema import MART_VWAP_COLUMNS  # noqa: E402
from tradelake.streaming import incremental as INC  # noqa: E402

SPLIT_MS = 1_705_276_800_000     # 2024-01-15 00:00 UTC: second half arrives after a restart


@register("stream_mart_vwap", W(O.vwap_ctes(), "select * from mart_vwap"),
          note="incremental foreachBatch refresh over two runs equals the full rebuild")
def q_stream_mart_vwap(spark, sf):
    bronze, cpath, vpath, opath, ck = (new_scratch_path(spark, n) for n in
                                       ("inc_bronze", "inc_candles", "inc_vwap", "inc_vol", "inc_ck"))
    trades = event_trades(spark, sf)
    for part in (F.col("timestamp") < SPLIT_MS, F.col("timestamp") >= SPLIT_MS):
        B.write_bronze(trades.where(part), bronze)
        INC.start_refresh(P.bronze_stream(spark, bronze), bronze, cpath, vpath, opath, ck,
                          available_now=True).awaitTermination()
    return spark.read.parquet(vpath).select(*MART_VWAP_COLUMNS)


from tradelake.streaming import rolling_state as RS  # noqa: E402


@register("stream_vwap_state", W(O.vwap_ctes(), "select * from mart_vwap"),
          note="ring of 60 candles and open hours as keyed state, over three runs; equals the batch mart")
def q_stream_vwap_state(spark, sf):
    src, out, ck = (new_scratch_path(spark, n) for n in ("state_candles", "state_vwap", "state_ck"))
    candles = ohlcv(events_stg(spark, sf))
    before = F.unix_millis("candle_time") < SPLIT_MS
    clock = candles.limit(1).withColumns({"symbol": F.lit(CLOCK), "candle_time": F.timestamp_millis(F.lit(1_735_689_600_000))})
    for part in (candles.where(before), candles.where(~before), clock):
        part.write.mode("append").parquet(src)
        P.write_append(RS.rolling_vwap_state(RS.candle_stream(spark, src)), out, ck).awaitTermination()
    return spark.read.parquet(out).select(*MART_VWAP_COLUMNS)
