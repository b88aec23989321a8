"""The batch build: bronze -> silver -> gold, as one DataFrame pipeline.

``build_gold`` writes silver candles once to the shared checkpoint folder and
reads them back, so both candle marts start from the written table instead
of recomputing trades -> candles twice (and a lost executor does not replay
the trade scan).  Each mart is then written as its own table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import SIDES, TIER_ORDER
from tradelake.functions.expressions import DEFAULT_WHALE_THRESHOLD
from tradelake.operators import quality as Q
from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.operators.volatility import mart_volatility
from tradelake.operators.vwap import mart_vwap
from tradelake.operators.whales import hourly_context, mart_whale_trades
from tradelake.session import new_scratch_path
from tradelake.sources.releases import PERIOD, Releases


@dataclass
class Layers:
    stg_trades: DataFrame
    candles: DataFrame | None
    mart_vwap: DataFrame | None
    mart_volatility: DataFrame | None
    mart_whale_trades: DataFrame | None


def layers(bronze: DataFrame, interval: str = "1 minute",
           whale_threshold: float = DEFAULT_WHALE_THRESHOLD,
           strategy: str = "blocked") -> Layers:
    """Lazy DataFrames of every layer (nothing runs until an action)."""
    stg = stg_trades(bronze)
    candles = ohlcv(stg, interval)
    return Layers(stg, candles, mart_vwap(candles, strategy), mart_volatility(candles, strategy),
                  mart_whale_trades(stg, whale_threshold))


def materialize(df: DataFrame, spark: SparkSession, name: str, partition_by=None,
                sort_by=None) -> DataFrame:
    """Write ``df`` under the shared checkpoint root and read it back.

    Cuts the lineage the way a table does: downstream stages read files, and a
    lost executor re-reads them instead of recomputing upstream stages.
    ``sort_by`` orders rows inside each file (tight row-group min/max for the
    serving filters) without a global sort.
    """
    path = new_scratch_path(spark, name)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def build_gold(spark: SparkSession, bronze: DataFrame, interval: str = "1 minute",
               whale_threshold: float = DEFAULT_WHALE_THRESHOLD, write=None,
               only: tuple[str, ...] | None = None) -> Layers:
    """Run the whole build; silver candles are written once and shared.

    ``write(name, df)`` stores a layer and reads it back (default: a scratch folder).
    ``only`` names the layers to build beside the trades (default: all)."""
    if write is None:
        order = {"stg_trades": "traded_at", "mart_whale_trades": "traded_at"}

        def write(name, df):
            return materialize(df, spark, name, sort_by=["symbol", order.get(name, "candle_time")])
    def layer(name, make):
        return write(name, make()) if only is None or name in only else None
    stg = write("stg_trades", stg_trades(bronze))
    candles = layer("stg_ohlcv", lambda: ohlcv(stg, interval))

    def whale_mart():
        context = materialize(hourly_context(stg, whale_threshold), spark, "hourly_context")
        return mart_whale_trades(stg, whale_threshold, context=context)
    return Layers(stg, candles, layer("mart_vwap", lambda: mart_vwap(candles)),
                  layer("mart_volatility", lambda: mart_volatility(candles)), layer("mart_whale_trades", whale_mart))


def quality_report(layers: Layers, bronze: DataFrame, as_of: Column | None = None,
                   symbols: list[str] | None = None) -> DataFrame:
    """The not-null / unique / accepted-values / range checks of every layer,
    as one findings table (rows with status "fail" are violations), and the
    freshness of bronze at ``as_of`` (now), with its own status: pass, warn or
    error, error also where no load time is known.  ``symbols``: the feed's accepted
    symbols, checked where they are given."""
    table = {"bronze_trades": bronze, "stg_trades": layers.stg_trades, "stg_ohlcv_1min": layers.candles,
             "mart_vwap": layers.mart_vwap, "mart_volatility": layers.mart_volatility,
             "mart_whale_trades": layers.mart_whale_trades}
    table = {k: v for k, v in table.items() if v is not None}       # a build may leave layers out
    required = {
        "bronze_trades": ["trade_id", "symbol", "price", "quantity", "timestamp", "ingested_at"],
        "stg_trades": ["trade_id", "symbol", "price", "quantity", "volume_usd", "side", "traded_at", "ingested_at"],
        "stg_ohlcv_1min": ["symbol", "candle_time", "open", "high", "low", "close", "volume_usd", "vwap", "volume_delta"],
        "mart_vwap": ["symbol", "candle_time", "vwap_30min", "vwap_60min", "price_vs_vwap"],
        "mart_volatility": ["symbol", "candle_time"],
        "mart_whale_trades": ["trade_id", "symbol", "traded_at", "volume_usd"]}
    ids = {"bronze_trades": ["trade_id"], "stg_trades": ["symbol", "trade_id"], "mart_whale_trades": ["trade_id"]}
    accepted = [("bronze_trades", "side", SIDES), ("stg_trades", "side", SIDES), ("mart_whale_trades", "side", SIDES),
                ("mart_whale_trades", "whale_tier", TIER_ORDER)]
    if symbols:
        accepted += [("bronze_trades", "symbol", symbols), ("stg_trades", "symbol", symbols)]
    nn = [Q.not_null(table[t], t, columns) for t, columns in required.items() if t in table]
    dup = Q.union_all([Q.unique(table[t], t, keys) for t, keys in ids.items() if t in table])
    bad = Q.union_all([Q.accepted_values(table[t], t, c, values) for t, c, values in accepted if t in table])
    rng = Q.range_check(layers.stg_trades, "stg_trades",
                        {"price_positive": F.col("price") > 0, "quantity_positive": F.col("quantity") > 0})
    fresh = Q.freshness(bronze, "bronze_trades", F.col("ingested_at").try_cast("timestamp"),
                        F.current_timestamp() if as_of is None else as_of)
    fresh = fresh.withColumn("status", F.when(F.col("max_loaded_at").isNull(), "error").otherwise(F.col("status")))
    as_rows = [
        dup.groupBy("table_name", "key_columns").agg(F.count(F.lit(1)).alias("failures"))
           .select("table_name", F.concat(F.lit("unique:"), "key_columns").alias("check"), "failures"),
        bad.groupBy("table_name", "column_name").agg(F.sum("n").alias("failures"))
           .select("table_name", F.concat(F.lit("accepted_values:"), "column_name").alias("check"), "failures"),
        rng.select("table_name", F.col("check_name").alias("check"), "failures"),
    ] + [x.select("table_name", F.concat(F.lit("not_null:"), "column_name").alias("check"), "failures")
         for x in nn]
    out = Q.union_all([x.select("table_name", "check", F.col("failures").cast("long").alias("failures"))
                       for x in as_rows])
    out = out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
    return out.unionByName(fresh.select(
        "table_name", F.lit("freshness:ingested_at").alias("check"),
        (F.col("status") != "pass").cast("long").alias("failures"), "status"))


class BuildFailed(RuntimeError):
    pass


class ChecksFailed(RuntimeError):
    """A build whose checks failed; it was not published.  ``report`` has the findings."""

    def __init__(self, failed: list[str], report: DataFrame):
        super().__init__("not published: " + ", ".join(failed))
        self.failed, self.report = failed, report


def staged_build(spark: SparkSession, bronze: DataFrame, releases: Releases, **kw) -> tuple[str, Layers]:
    """Write all layers of a new version of ``releases``; readers do not see it."""
    version = releases.new_version()
    try:
        return version, build_gold(spark, bronze, write=lambda name, df: releases.stage(version, name, df).drop(PERIOD), **kw)
    except Exception as exc:  # noqa: BLE001
        raise BuildFailed(str(exc)) from exc


def scheduled_run(spark: SparkSession, bronze: DataFrame, releases: Releases | None = None, as_of: Column | None = None,
                  symbols: list[str] | None = None, tolerate: tuple[str, ...] = (), stale_blocks: bool = False,
                  keep: int = 2, **kw) -> tuple[Layers, DataFrame]:
    """One scheduled rebuild: build a staged version, check what was written, publish
    it by one switch, and remove all but the last ``keep`` versions.

    An exception in the build stops the run before any check (``BuildFailed``); a
    check that fails stops it before the switch (``ChecksFailed``).  Either way
    readers keep the version they have.  ``tolerate`` names checks, as
    ``table.check``, that are reported but do not block; nor does an old load time,
    unless ``stale_blocks``.  Returns the published layers and the report."""
    releases = releases or Releases(spark, "default")
    version, built = staged_build(spark, bronze, releases, **kw)
    report = materialize(quality_report(built, bronze, as_of, symbols), spark, "quality_report")
    blocking = [F.col("status") == "fail"] + ([F.col("status") == "error"] if stale_blocks else [])
    bad = report.where(reduce(Column.__or__, blocking)).select("table_name", "check").collect()   # a few checks
    failed = sorted({f"{r.table_name}.{r.check}" for r in bad} - set(tolerate))
    if failed:
        raise ChecksFailed(failed, report)
    releases.publish(version)
    releases.register(version)
    releases.prune(keep)
    return built, report
