"""Bronze storage: hive-partitioned Parquet ``symbol=/year=/month=/day=``.

Each row's directory comes from its own trade time (UTC), so a batch that
spans midnight lands in two day directories.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.schema import BRONZE_PARTITIONS, BRONZE_READ_SCHEMA, BRONZE_SCHEMA


def with_partition_columns(trades: DataFrame) -> DataFrame:
    ts = F.timestamp_millis(F.col("timestamp"))
    return trades.withColumns({
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    })


def write_bronze(trades: DataFrame, path: str, mode: str = "append", batch_id: int | None = None) -> None:
    """Append trades under their (symbol, year, month, day) directories, with
    the types of the bronze schema (a value that does not fit is an error).

    Rows are sorted by directory within each task, so a task keeps one open
    file at a time; it never shuffles (small files are the compactor's job).
    With ``batch_id`` each directory gets one more level, ``batch=<id>``, which a
    replay of that micro-batch replaces instead of adding to it.
    """
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields]
    rows, keys = with_partition_columns(trades.select(*typed)), list(BRONZE_PARTITIONS)
    if batch_id is not None:
        rows, keys, mode = rows.withColumn("batch", F.lit(batch_id)), [*keys, "batch"], "overwrite"
    (rows.sortWithinPartitions(*BRONZE_PARTITIONS)
     .write.mode(mode).option("compression", "snappy")
     .option("partitionOverwriteMode", "static" if batch_id is None else "dynamic")
     .partitionBy(*keys).parquet(path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Scan with a fixed schema: partition values stay text ("01")."""
    return (spark.read.schema(BRONZE_READ_SCHEMA).option("basePath", path).parquet(path)
            .select(*BRONZE_READ_SCHEMA.fieldNames()))


def bronze_view(spark: SparkSession, path: str, name: str = "trades") -> DataFrame:
    read_bronze(spark, path).createOrReplaceTempView(name)
    return spark.table(name)


def day_filter(symbol: str | None, day: str | None):
    """Predicate on directory columns only, so it prunes files at planning."""
    cond = F.lit(True)
    if symbol is not None:
        cond = cond & (F.col("symbol") == F.lit(symbol))
    if day is not None:
        y, m, d = day.split("-")
        cond = cond & (F.col("year") == F.lit(y)) & (F.col("month") == F.lit(m)) & (F.col("day") == F.lit(d))
    return cond


def time_range_filter(start_ms: int, end_ms: int):
    """Trade-time range plus the implied day directories (derived partition
    predicate the optimizer cannot infer from ``timestamp`` by itself)."""
    days = []
    d = dt.datetime.fromtimestamp(start_ms / 1000, dt.timezone.utc).date()
    last = dt.datetime.fromtimestamp(end_ms / 1000, dt.timezone.utc).date()
    while d <= last:
        days.append(d.strftime("%Y-%m-%d"))
        d += dt.timedelta(days=1)
    day_key = F.concat_ws("-", "year", "month", "day")
    return (day_key.isin(*days) & (F.col("timestamp") >= F.lit(start_ms))
            & (F.col("timestamp") < F.lit(end_ms)))


def compact_bronze(spark: SparkSession, src: str, dst: str, days: list[str] | None = None,
                   max_records_per_file: int = 5_000_000) -> DataFrame:
    """Rewrite bronze into few large, time-sorted files per directory.

    The rebalance on the directory columns lets AQE merge small directories
    into one task and split a hot symbol-day by its size, so files follow
    ``advisoryPartitionSizeInBytes``.  ``days`` (yyyy-mm-dd) restricts the run to
    some day directories.  Sorting by trade time inside each file gives tight
    row-group min/max for time filters.
    """
    rows = read_bronze(spark, src)
    if days is not None:
        rows = rows.where(F.concat_ws("-", "year", "month", "day").isin(*days))
    (rows.hint("rebalance", *BRONZE_PARTITIONS)
     .sortWithinPartitions(*BRONZE_PARTITIONS, "timestamp", "trade_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if days is not None else "static")
     .option("compression", "snappy").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*BRONZE_PARTITIONS).parquet(dst))
    return read_bronze(spark, dst)
