"""Incremental candle and mart refresh for a trade stream (``foreachBatch``).

Row-frame windows cannot run on a stream, and a late trade changes its
candle, up to 59 following VWAP rows, its hour's VWAP, and so on.  Each
micro-batch therefore recomputes exactly what it can have changed:

1. the (symbol, minute) pairs the batch touches: those of its trades, and those
   of earlier copies of the same trades, which dedup may now decide otherwise;
2. those candles, from all bronze trades of those minutes and all copies of
   these trades within the replay horizon (so that dedup sees what the batch
   build sees), merged into their (symbol, day) partitions and written back
   with dynamic partition overwrite;
3. the marts of each touched symbol from its first touched day to the day that
   holds the 60th candle after its last touched one -- later rows cannot change
   -- reading as many earlier days as hold the 60 candles the windows look back
   over, and writing only the days in between, again with dynamic overwrite.

Every write replaces whole (symbol, day) partitions computed from bronze, so
replaying a batch after a failure gives the same tables.  Joins carry no
broadcast hints: a first or a backlog batch can be the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.operators.candles import ohlcv
from tradelake.operators.silver import stg_trades
from tradelake.operators.volatility import mart_volatility
from tradelake.operators.vwap import mart_vwap
from tradelake.schema import CANDLES_READ_SCHEMA
from tradelake.session import new_scratch_path
from tradelake.sources.bronze import read_bronze

LOOKBACK_ROWS = 60          # the longest row frame (VWAP-60) reaches 59 rows back
REPLAY_DAYS = 31            # copies of a trade are looked for this far around a batch
DAY_MS = 86_400_000


def _day(ts_col: str) -> F.Column:
    return F.date_format(F.col(ts_col), "yyyy-MM-dd")


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the (symbol, day) partitions present in ``df``.

    A (symbol, day) holds at most one candle per minute (1,440 rows), so
    clustering on it gives one file per directory without a hot task.
    """
    (df.repartition("symbol", "day").sortWithinPartitions("symbol", "day", "candle_time")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("symbol", "day").parquet(path))


def minutes_of(trades: DataFrame) -> DataFrame:
    """(symbol, day, minute) of trades."""
    ts = F.timestamp_millis("timestamp")
    return (trades.where(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
            .select("symbol", F.date_format(ts, "yyyy-MM-dd").alias("day"),
                    F.date_trunc("minute", ts).alias("candle_time"))
            .distinct())


def around(spark: SparkSession, bronze_path: str, times: DataFrame, column: str, replay_days: int) -> DataFrame:
    """Bronze within the replay horizon of ``times``: the day directories are
    pruned by the range, which two values of the driver bound."""
    lo, hi = times.agg(F.min(column), F.max(column)).first()
    lo, hi = (lo or 0) - replay_days * DAY_MS, (hi or 0) + replay_days * DAY_MS
    day = F.concat_ws("-", "year", "month", "day")
    first, last = (F.date_format(F.timestamp_millis(F.lit(v)), "yyyy-MM-dd") for v in (lo, hi))
    return read_bronze(spark, bronze_path).where(
        (day >= first) & (day <= last) & F.col("timestamp").between(lo, hi))


def touched_minutes(spark: SparkSession, batch: DataFrame, bronze_path: str, replay_days: int = REPLAY_DAYS) -> DataFrame:
    """The minutes a batch can change: its own, and those of copies of its trades."""
    known = batch.where("symbol is not null and trade_id is not null and timestamp is not null")
    copies = (around(spark, bronze_path, known, "timestamp", replay_days)
              .join(known.select("symbol", "trade_id").distinct(), ["symbol", "trade_id"], "left_semi"))
    return minutes_of(known.select("symbol", "timestamp").unionByName(copies.select("symbol", "timestamp")))


def touched_days(touched: DataFrame) -> DataFrame:
    return touched.select("symbol", "day").distinct()


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """Scan with a fixed schema: a symbol such as "0700" stays text."""
    return spark.read.schema(CANDLES_READ_SCHEMA).option("basePath", path).parquet(path)


def refresh_candles(spark: SparkSession, bronze_path: str, candles_path: str, touched: DataFrame,
                    replay_days: int = REPLAY_DAYS) -> None:
    """Recompute only the touched minutes' candles and rewrite their
    (symbol, day) partitions; a day that lost its last candle is removed."""
    days = touched_days(touched)
    minutes = touched.select("symbol", "candle_time")
    spans = touched.select(F.unix_millis("candle_time").alias("ms"))
    trades = around(spark, bronze_path, spans, "ms", replay_days)
    there = (trades.withColumn("candle_time", F.date_trunc("minute", F.timestamp_millis("timestamp")))
             .join(minutes, ["symbol", "candle_time"], "left_semi").select("symbol", "trade_id").distinct())
    fresh = (ohlcv(stg_trades(trades.join(there, ["symbol", "trade_id"], "left_semi")))
             .join(minutes, ["symbol", "candle_time"], "left_semi")
             .withColumn("day", _day("candle_time")))
    merged = fresh
    if _exists(spark, candles_path):
        kept = (read_candles(spark, candles_path).join(days, ["symbol", "day"], "left_semi")
                .join(minutes, ["symbol", "candle_time"], "left_anti"))
        merged = kept.unionByName(fresh)
    _replace(spark, merged, candles_path, days)


def _replace(spark: SparkSession, rows: DataFrame, path: str, scope: DataFrame) -> None:
    """Make the (symbol, day) partitions of ``scope`` hold just ``rows``: those
    that ``rows`` has are replaced, the others removed.  ``rows`` is staged first,
    as it may be read from the very partitions."""
    staged = new_scratch_path(spark, "stage")
    rows.write.parquet(staged)
    try:
        made = spark.read.schema(rows.schema).parquet(staged)
        _overwrite(made, path)
        gone = scope.join(made.select("symbol", "day").distinct(), ["symbol", "day"], "left_anti")
        for r in gone.toLocalIterator():
            _delete(spark, f"{path}/symbol={r.symbol}/day={r.day}")
    finally:
        _delete(spark, staged)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _reach(counts: DataFrame, edge: DataFrame, rows: int, back: bool) -> DataFrame:
    """Per symbol: the farthest day needed before (or after) its ``edge`` day so
    that the days in between hold ``rows`` candles, and how many they hold."""
    order = F.col("day").desc() if back else F.col("day").asc()
    nearer = Window.partitionBy("symbol").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    beyond = F.col("day") < F.col("edge") if back else F.col("day") > F.col("edge")
    needed = (counts.join(edge, "symbol").where(beyond)
              .withColumn("_held", F.coalesce(F.sum("n").over(nearer), F.lit(0)))
              .where(F.col("_held") < rows))
    far = F.min("day") if back else F.max("day")
    return needed.groupBy("symbol").agg(far.alias("far"), F.max(F.col("_held") + F.col("n")).alias("found"))


def days_within(bounds: DataFrame) -> DataFrame:
    """Every (symbol, day) that a refresh of ``bounds`` rewrites."""
    day = F.explode(F.sequence(F.to_date("first_day"), F.to_date("end_day")))
    return bounds.select("symbol", day.alias("day")).select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day"))


def refresh_marts(spark: SparkSession, candles_path: str, vwap_path: str, vol_path: str,
                  touched: DataFrame, lookback_rows: int = LOOKBACK_ROWS,
                  lookback_days: int = 7) -> None:
    """Recompute the marts of the touched symbols where they can have changed.

    Per-day candle counts are read only from ``lookback_days`` before the
    earliest touched day on (a static partition filter); a symbol whose recent
    days hold fewer than ``lookback_rows`` candles falls back to counting its
    whole history, so the look-back is exact either way.
    """
    span = touched_days(touched).groupBy("symbol").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    lo = span.agg(F.date_format(F.date_sub(F.to_date(F.min("first_day")), lookback_days),
                                "yyyy-MM-dd")).first()[0]          # one value
    candles = read_candles(spark, candles_path)

    def day_counts(df):
        return df.groupBy("symbol", "day").agg(F.count(F.lit(1)).alias("n"))

    recent = day_counts(candles.where(F.col("day") >= F.lit(lo)))
    first = span.select("symbol", F.col("first_day").alias("edge"))
    back = _reach(recent, first, lookback_rows, True)
    short = first.join(back, "symbol", "left").where(
        F.coalesce(F.col("found"), F.lit(0)) < lookback_rows).select("symbol", "edge")
    whole = _reach(day_counts(candles.join(short.select("symbol"), "symbol", "left_semi")), short, lookback_rows, True)
    start = (back.join(short.select("symbol"), "symbol", "left_anti").select("symbol", F.col("far").alias("start_day"))
             .unionByName(whole.select("symbol", F.col("far").alias("start_day"))))
    end = _reach(recent, span.select("symbol", F.col("last_day").alias("edge")), lookback_rows, False).select(
        "symbol", F.col("far").alias("end_day"))
    # One row per touched symbol, and the candles both marts start from: kept
    # for this batch only (several plan branches read them; a lost block is
    # recomputed from its lineage).
    bounds = (span.join(start, "symbol", "left").join(end, "symbol", "left")
              .select("symbol", "first_day", F.coalesce("start_day", "first_day").alias("start_day"),
                      F.coalesce("end_day", "last_day").alias("end_day"))).persist()
    frame = (candles.join(bounds, "symbol")
             .where(F.col("day").between(F.col("start_day"), F.col("end_day")))
             .drop("day", "start_day", "first_day", "end_day")).persist()
    try:
        fd = bounds.select("symbol", "first_day")
        scope = days_within(bounds)
        for mart, path in ((mart_vwap, vwap_path), (mart_volatility, vol_path)):
            out = (mart(frame).withColumn("day", _day("candle_time"))
                   .join(fd, "symbol").where(F.col("day") >= F.col("first_day"))
                   .drop("first_day"))
            _replace(spark, out, path, scope)
    finally:
        frame.unpersist()
        bounds.unpersist()


def refresh_batch(bronze_path: str, candles_path: str, vwap_path: str, vol_path: str):
    """``foreachBatch`` body over a bronze trade stream."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = touched_minutes(spark, batch, bronze_path).persist()
        try:
            if touched.isEmpty():
                return
            refresh_candles(spark, bronze_path, candles_path, touched)
            refresh_marts(spark, candles_path, vwap_path, vol_path, touched)
        finally:
            touched.unpersist()
    return run


def start_refresh(bronze: DataFrame, bronze_path: str, candles_path: str, vwap_path: str,
                  vol_path: str, checkpoint: str, available_now: bool = False,
                  processing_time: str = "5 minutes"):
    w = (bronze.writeStream.foreachBatch(refresh_batch(bronze_path, candles_path, vwap_path, vol_path))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
