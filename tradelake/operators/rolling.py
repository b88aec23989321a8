"""Row-frame windows over long per-key histories, split into halo blocks.

``Window.partitionBy("symbol")`` puts each symbol's whole history into one
task: with a handful of symbols, a handful of tasks do all the work, and one
hot symbol bounds the job.  A window whose frame reaches at most ``halo`` rows
back only needs those rows from the previous block, so the series is cut into
blocks of ``block_rows`` consecutive rows, the last ``halo`` rows of each
block are copied into the next one, the window runs per (key, block), and the
copies are dropped again.  The result equals the plain window exactly.

Steps (all DataFrame operations):

1. count rows per (key, day) -- a table of keys x days, tiny next to the data;
2. running total of those counts per key = row offset of each day;
3. global row number = day offset + ``row_number()`` within (key, day);
4. ``block = (rn - 1) div block_rows``; rows in the last ``halo`` positions of
   a block are emitted twice (``explode``), the copy tagged ``_halo`` and
   moved to the next block;
5. the caller evaluates its window expressions over ``spec``
   (partition by key + block, order by row number) on ``frame``;
6. ``finish`` drops the halo copies and the helper columns.

Per-task work is bounded by ``block_rows + halo`` rows per window partition
and by one day of one key for the numbering step, whatever the skew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 8192
HELPER_COLUMNS = ["_bkt", "_rn", "_blk", "_halo", "_copy"]


@dataclass
class Rolling:
    frame: DataFrame
    spec: WindowSpec          # ordered, unbounded; add rowsBetween per use

    def finish(self, df: DataFrame) -> DataFrame:
        if "_halo" in df.columns:
            df = df.where(~F.col("_halo"))
        return df.drop(*[c for c in HELPER_COLUMNS if c in df.columns])


def plain(df: DataFrame, keys: list[str], order_col: str) -> Rolling:
    return Rolling(df, Window.partitionBy(*keys).orderBy(F.col(order_col).asc()))


def blocked(df: DataFrame, keys: list[str], order_col: str, halo: int,
            block_rows: int = DEFAULT_BLOCK_ROWS, bucket_unit: str = "day") -> Rolling:
    """Halo-blocked frame; ``order_col`` must be a timestamp unique per key."""
    if halo < 0 or halo > block_rows:
        raise ValueError("need 0 <= halo <= block_rows")
    bkt = F.date_trunc(bucket_unit, F.col(order_col))
    with_bkt = df.withColumn("_bkt", bkt)
    counts = with_bkt.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bkt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets has one row per (key, day): AQE broadcasts it when its measured
    # size is under the broadcast threshold and sort-merges it otherwise.
    numbered = (with_bkt.join(offsets, [*keys, "_bkt"], "inner")
                .withColumn("_rn", F.col("_off") + F.row_number().over(
                    Window.partitionBy(*keys, "_bkt").orderBy(F.col(order_col).asc())))
                .drop("_off"))
    b = F.lit(block_rows)
    pos = F.pmod(F.col("_rn") - 1, b)
    copies = F.when(pos >= F.lit(block_rows - halo), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    framed = (numbered.withColumn("_copy", F.explode(copies))
              .withColumn("_blk", F.floor((F.col("_rn") - 1) / b).cast("long") + F.col("_copy"))
              .withColumn("_halo", F.col("_copy") == 1))
    return Rolling(framed, Window.partitionBy(*keys, "_blk").orderBy(F.col("_rn").asc()))


def rolling(df: DataFrame, keys: list[str], order_col: str, halo: int,
            strategy: str = "blocked", block_rows: int = DEFAULT_BLOCK_ROWS) -> Rolling:
    """Pick the window layout: ``blocked`` (default, skew-proof) or ``plain``."""
    if strategy == "plain":
        return plain(df, keys, order_col)
    if strategy == "blocked":
        return blocked(df, keys, order_col, halo, block_rows)
    raise ValueError(f"unknown strategy {strategy!r}")


def running_sum(df: DataFrame, keys: list[str], order_col: str, value_col: str,
                out_col: str, scale: int = 8, bucket_unit: str = "day") -> DataFrame:
    """Cumulative sum from the first row of each key, without a per-key task.

    Per (key, day) totals are prefix-summed over days (small table), and each
    row adds its within-day running sum.  Values are summed as decimals, so
    the split summation order gives exactly the sequential result.
    """
    dec = f"decimal(38,{scale})"
    v = F.col(value_col).cast(dec)
    with_bkt = df.withColumn("_bkt", F.date_trunc(bucket_unit, F.col(order_col)))
    totals = with_bkt.groupBy(*keys, "_bkt").agg(F.sum(v).alias("_tot"))
    before = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bkt", F.coalesce(F.sum("_tot").over(before), F.lit(0).cast(dec)).alias("_off"))
    within = Window.partitionBy(*keys, "_bkt").orderBy(F.col(order_col).asc()).rowsBetween(Window.unboundedPreceding, 0)
    return (with_bkt.join(offsets, [*keys, "_bkt"], "inner")
            .withColumn(out_col, (F.col("_off") + F.coalesce(F.sum(v).over(within), F.lit(0).cast(dec))).cast("double"))
            .drop("_bkt", "_off"))
