"""``rank() over (partition by g order by v desc)`` without a hot partition.

A plain window sorts each group in one task, so a group holding a third of
the rows is a third of the job in one task.  Here the rank is computed as

    rank(v) = 1 + (rows of the group with a larger value)

from small tables, then joined back:

1. ``groupBy(g, v).count()`` -- one row per distinct value; the map-side
   partial step collapses a value repeated millions of times to one row per
   task before the shuffle;
2. the value axis of each group is cut into monotone sub-buckets (``2^-10``
   of an octave); per-(group, bucket) totals are a small table whose running
   sum over buckets gives "rows in higher buckets";
3. within a (group, bucket), a running sum over the distinct values gives
   "rows with a larger value in the same bucket";
4. the rank of each distinct value is joined back to the rows on (g, v); a
   value that still holds many rows is a skewed join key, which AQE's skew
   join splits.

Equal values get equal ranks and the next rank skips, exactly as ``rank()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 1024


def value_bucket(v) -> F.Column:
    """Monotone non-decreasing bucket of a double (log scale, signed)."""
    mag = F.floor(F.log2(F.abs(v)) * F.lit(BUCKETS_PER_OCTAVE)).cast("long")
    return (F.when(v > 0, F.lit(1 << 40) + mag)
            .when(v < 0, -(F.lit(1 << 40) + mag))
            .otherwise(F.lit(0)).cast("long"))


def rank_desc(df: DataFrame, group_cols: list[str], value_col: str, out_col: str,
              strategy: str = "split") -> DataFrame:
    """Add ``out_col`` = rank of ``value_col`` (descending) within ``group_cols``.

    NULL values rank last (after every non-NULL), like ``ORDER BY v DESC``
    with NULLS LAST.  ``df`` is read for the counts of its values and again for its
    rows, so give a written table: what made it would run for each of them.
    """
    if strategy == "plain":
        w = Window.partitionBy(*group_cols).orderBy(F.col(value_col).desc_nulls_last())
        return df.withColumn(out_col, F.rank().over(w).cast("long"))
    if strategy != "split":
        raise ValueError(strategy)
    v = F.col(value_col)
    keys = [*group_cols, value_col]
    vals = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_b", F.when(v.isNull(), F.lit(-(1 << 62))).otherwise(value_bucket(v))))
    per_bucket = vals.groupBy(*group_cols, "_b").agg(F.sum("_n").alias("_bn"))
    higher = Window.partitionBy(*group_cols).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(*group_cols, "_b", F.coalesce(F.sum("_bn").over(higher), F.lit(0)).alias("_off"))
    larger = (Window.partitionBy(*group_cols, "_b").orderBy(v.desc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    ranks = (vals.withColumn("_in", F.coalesce(F.sum("_n").over(larger), F.lit(0)))
             .join(offsets, [*group_cols, "_b"], "inner")
             .select(*[F.col(c).alias(f"_r_{c}") for c in keys],
                     (F.lit(1) + F.col("_off") + F.col("_in")).cast("long").alias(out_col)))
    # null-safe equality keeps rows whose value is NULL; the value goes first, as the join
    # sorts by it and few rows share one
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in reversed(keys)]
    return df.join(ranks, cond, "left").drop(*[f"_r_{c}" for c in keys])
