"""Streaming jobs.  The transforms are the batch operators; only the source,
the watermark and the sink differ.

* ``bronze_ingest``   raw frames -> bronze Parquet + dead-letter Parquet
                      (``foreachBatch``; one parse per batch, two sinks);
* ``stream_trades``   bronze file stream -> deduplicated, cleaned trades
                      (watermark + ``dropDuplicatesWithinWatermark``);
* ``stream_candles``  trades -> OHLCV per event-time window (append: a
                      candle is emitted once the watermark passes its end);
* ``whale_alerts``    stateless filter of large trades;
* ``whale_context_batch``  per micro-batch join of new whales to the current
                      hourly market table (static side re-read each batch);
* ``whale_context_stream``  stream-stream join of whales with their hour, each
                      emitted once the hour is closed, so its context is final.

Batch dedup keeps the least ``ingested_at``; the stream keeps the first
arrival.  They agree whenever copies arrive in ingestion order.
"""

from __future__ import annotations

import threading

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions import round_half_away, safe_div, xsum
from tradelake.functions.expressions import DEFAULT_WHALE_THRESHOLD
from tradelake.operators.candles import candle_aggs
from tradelake.operators.silver import DEDUP_KEYS, clean_trades
from tradelake.operators.whales import context_aggs, share_of_hour, whale_base, whale_filter, with_hour
from tradelake.schema import BRONZE_COLUMNS, BRONZE_READ_SCHEMA, OHLCV_COLUMNS, STG_READ_SCHEMA
from tradelake.sources.bronze import write_bronze
from tradelake.sources.raw import parse_with_rejects

# Fixed value: flush interval of the ingest, in seconds (the trigger period).
# Batch size is bounded by the source instead (maxOffsetsPerTrigger /
# maxFilesPerTrigger), sized to the cluster rather than to a row count.
FLUSH_SECONDS = 30

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_START = threading.Lock()

# Rows and bytes that a task packs at once, rows of an hour in one packed row.
PACK_ROWS, PACK_BYTES, CHUNK = 1 << 20, 64 << 20, 4096


def frame_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw frames from text files (one JSON frame per line); arrival = now."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select("value", F.current_timestamp().alias("timestamp"))


def bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(BRONZE_READ_SCHEMA).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select(*BRONZE_COLUMNS)


def _write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Rows of one micro-batch in a directory of its own: a replay replaces it."""
    (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def _ingest_batch(bronze_path: str, rejects_path: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_with_rejects(batch).persist()
        try:
            good = parsed.where(F.col("reject_reason").isNull()).select(*BRONZE_COLUMNS)
            write_bronze(good, bronze_path, batch_id=batch_id)
            _write_batch(parsed.where(F.col("reject_reason").isNotNull())
                         .select("raw", "reject_reason", "ingested_at"), batch_id, rejects_path)
        finally:
            parsed.unpersist()
    return run


def bronze_ingest(frames: DataFrame, bronze_path: str, rejects_path: str, checkpoint: str,
                  processing_time: str | None = f"{FLUSH_SECONDS} seconds", available_now: bool = False):
    """Start the frames -> bronze query.  Every batch writes directories that
    carry its id and replaces them if it is replayed after a crash, so a row is
    delivered once; copies that the broker delivers twice are left to dedup."""
    w = frames.writeStream.foreachBatch(_ingest_batch(bronze_path, rejects_path)).option(
        "checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def stream_trades(bronze: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Deduplicated, typed, valid trades with an event-time watermark."""
    with_time = bronze.withColumn("traded_at", F.timestamp_millis(F.col("timestamp").cast("long")))
    deduped = (with_time.withWatermark("traded_at", watermark)
               .dropDuplicatesWithinWatermark(DEDUP_KEYS))
    return clean_trades(deduped)


def stream_candles(trades: DataFrame, interval: str = "1 minute", keep_window: bool = False) -> DataFrame:
    """Candles per event-time window.  ``keep_window`` keeps the window struct
    ``w`` so a coarser aggregation can chain on its event time."""
    win = F.window("traded_at", interval)
    out = (trades.groupBy(F.col("symbol"), win.alias("w")).agg(*candle_aggs())
           .withColumn("candle_time", F.col("w.start")))
    return out.select(*OHLCV_COLUMNS, *(["w"] if keep_window else []))


def stream_hourly(minute_candles: DataFrame) -> DataFrame:
    """Hourly roll-up chained on minute candles (``stream_candles(...,
    keep_window=True)``) through ``window_time``, which carries the event
    time and watermark of the first aggregation into the second."""
    hour = F.window(F.window_time("w"), "1 hour")
    return (minute_candles.groupBy("symbol", hour.alias("h"))
            .agg(round_half_away(safe_div(xsum("volume_usd", 2), xsum("volume", 8)), 6).alias("vwap"),
                 round_half_away(xsum("volume_usd", 2), 2).alias("total_volume_usd"),
                 round_half_away(xsum("volume", 8), 8).alias("total_volume"),
                 F.sum("trade_count").alias("trade_count"),
                 F.max("high").alias("high"), F.min("low").alias("low"),
                 F.min_by("open", "candle_time").alias("open"), F.max_by("close", "candle_time").alias("close"),
                 round_half_away(F.max("high") - F.min("low"), 6).alias("price_range"))
            .select("symbol", F.col("h.start").alias("hour"), "vwap", "total_volume_usd", "total_volume",
                    "trade_count", "high", "low", "open", "close", "price_range"))


def whale_alerts(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD) -> DataFrame:
    return whale_filter(trades, threshold).select("symbol", "trade_id", "traded_at", "side",
                                                  "price", "volume_usd")


def write_append(df: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 partition_by: list[str] | None = None, state_partitions: int | None = None):
    """File sink: exactly-once files through the sink's own commit log.

    Stateful operators keep one RocksDB state store (off the heap) per shuffle
    partition.  Their number is fixed when the checkpoint is created, so give
    ``state_partitions`` the parallelism the job is to have at its largest; the
    default, the cluster's parallelism now, is for runs that end by themselves.
    Starts are serialised, and the session's own settings are put back.
    """
    spark = df.sparkSession
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    n = state_partitions or max(1, spark.sparkContext.defaultParallelism)
    settings = {"spark.sql.shuffle.partitions": str(n), "spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    with _START:  # the query takes its settings from the session as it starts
        before = {k: spark.conf.get(k, None) for k in settings}
        try:
            for k, v in settings.items():
                spark.conf.set(k, v)
            return w.start(path)
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def whale_context_batch(hourly_market_path: str, out_path: str,
                        threshold: float = DEFAULT_WHALE_THRESHOLD):
    """``foreachBatch`` body: join the batch's whales to the hourly table as
    it is now (re-read each batch, so it sees the latest rebuild).  A replayed
    batch replaces what it wrote."""
    def run(batch: DataFrame, batch_id: int) -> None:
        hourly = batch.sparkSession.read.parquet(hourly_market_path)
        _write_batch(with_hour(whale_base(batch, threshold), hourly), batch_id, out_path)
    return run


def silver_stream(spark: SparkSession, path: str, watermark: str = "10 minutes",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Clean trades from the files that ``stream_trades`` or ``settled_trades`` write."""
    r = spark.readStream.schema(STG_READ_SCHEMA).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).withWatermark("traded_at", watermark)


def packed(rows: DataFrame, by: list[str], name: str = "rows") -> DataFrame:
    """``rows`` with those that are equal in ``by`` put together, as far as a task of a
    micro-batch finds them: ``by`` and ``name``, an array of at most ``CHUNK`` rows.  No state."""
    out = T.StructType([f for f in rows.schema if f.name in by]
                       + [T.StructField(name, T.ArrayType(T.StructType([f for f in rows.schema if f.name not in by])))])
    by, most, most_bytes, chunk = [f.name for f in out][:-1], PACK_ROWS, PACK_BYTES, CHUNK

    def pack(batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        key = np.zeros(len(table), np.int64)
        for c in by:
            code = pc.dictionary_encode(table.column(c), null_encoding="encode").combine_chunks()
            key = key * max(1, len(code.dictionary)) + code.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        begins = np.flatnonzero(np.diff(key, prepend=-1))
        turn = np.arange(len(key)) - np.repeat(begins, np.diff(np.append(begins, len(key))))
        begins = np.flatnonzero(turn % chunk == 0)
        rest = table.drop_columns(by).take(pa.array(order)).to_struct_array()
        rest = pa.concat_arrays(rest.chunks) if isinstance(rest, pa.ChunkedArray) else rest
        lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(key)), pa.int32()), rest)
        heads = table.select(by).take(pa.array(order[begins])).combine_chunks()
        for lo in range(0, len(begins), 256):
            some = heads.slice(lo, 256)
            yield pa.RecordBatch.from_arrays([*(some.column(c).combine_chunks() for c in by), lists.slice(lo, 256)], [*by, name])

    def run(batches):
        held, many, size = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                many, size = many + batch.num_rows, size + batch.nbytes
            if many >= most or size >= most_bytes:
                yield from pack(held)
                held, many, size = [], 0, 0
        if held:
            yield from pack(held)

    return rows.mapInArrow(run, out)


def whale_context_stream(trades: DataFrame, threshold: float = DEFAULT_WHALE_THRESHOLD,
                         columns: list[str] | None = None) -> DataFrame:
    """Whales of a clean trade stream (with a watermark on ``traded_at``) beside the
    final totals of their hour; ``columns``: those asked for, all if None.

    The hour's totals are an event-time aggregate, which comes out once when the
    watermark passes the hour's end; whales wait for it in the join's state, which that
    end, a key of the join, clears on both sides.  So no whale is emitted with half an
    hour's totals, and nothing has to be corrected later.  State is written and read a
    row at a time, so a task's whales of an hour wait in one row, with the asked columns
    only.  The join is an outer one: a whale whose hour closed before it arrived has
    null totals, a late one of an open hour has the totals that count it.
    """
    whales = whale_base(trades, threshold)
    own = whales.columns
    wait = [c for c in own if columns is None or c in columns or c in ("symbol", "hour", "volume_usd")]
    hours = (trades.groupBy(F.col("symbol").alias("_symbol"), F.window("traded_at", "1 hour").alias("_w"))
             .agg(*context_aggs(threshold))
             .withColumn("_close", F.window_time("_w")).drop("_w"))
    close = F.col("hour") + F.expr("interval 1 hour") - F.expr("interval 1 microsecond")
    both = (packed(whales.select(*wait), ["symbol", "hour"], "_whales")
            .join(hours, (F.col("symbol") == F.col("_symbol")) & (close == F.col("_close")), "leftOuter")
            .withColumn("_whale", F.explode("_whales")))
    context = [c for c in hours.columns if c not in ("_symbol", "_close")]
    out = share_of_hour(both.select(*(F.col(c) if c in ("symbol", "hour") else F.col("_whale")[c].alias(c) for c in wait), *context))
    return out if columns is None else out.select(*columns)
