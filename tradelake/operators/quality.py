"""Data-quality assertions.  Each returns its findings as a DataFrame.

* ``not_null``     one row per checked column with its NULL count (one scan
                   per table: all counts in a single aggregate, unpivoted);
* ``unique``       one row per duplicated key (partial aggregation, so a hot
                   key costs one row per task before the shuffle);
* ``accepted_values``  one row per value outside the accepted set;
* ``freshness``    newest load time vs ``as_of``: pass / warn / error;
* ``range_check``  one row per predicate with its violation count.

``status`` is "pass" when nothing is violated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source freshness thresholds, in minutes.
FRESHNESS_WARN_MIN = 10
FRESHNESS_ERROR_MIN = 30


def _status(failures: Column) -> Column:
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = counts.select(F.expr(f"stack({len(columns)}, {pairs}) as (column_name, failures)"))
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.col("failures").cast("long").alias("failures"),
                       _status(F.col("failures")).alias("status"))


def unique(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    key_text.alias("key_value"), "n"))


def key_counts(df: DataFrame, keys: list[str], **subsets: Column) -> DataFrame:
    """Rows of each key (n) and how many of them fulfil each named condition: one
    aggregate from which the repeats of any part of the key follow."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in subsets.items()])


def repeated(counts: DataFrame, table: str, keys: list[str], measure: str = "n") -> DataFrame:
    """``unique`` from ``key_counts`` of the same or finer keys."""
    rows = counts.groupBy(*keys).agg(F.sum(measure).alias("n"))
    key_text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (rows.where(F.col("n") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
                    key_text.alias("key_value"), "n"))


def accepted_values(df: DataFrame, table: str, column: str, values: list[str]) -> DataFrame:
    """Values outside the set; NULL is not a violation (``NOT IN`` is unknown)."""
    c = F.col(column)
    return (df.where(~c.isin(*values)).groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    F.col("value").cast("string").alias("value"), "n"))


def freshness(df: DataFrame, table: str, loaded_at: Column, as_of: Column,
              by: list[str] | None = None, warn_min: int = FRESHNESS_WARN_MIN,
              error_min: int = FRESHNESS_ERROR_MIN) -> DataFrame:
    by = by or []
    g = df.groupBy(*by) if by else df.groupBy()
    newest = g.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_micros(as_of) - F.unix_micros(F.col("max_loaded_at"))).cast("double") / F.lit(60e6)
    status = (F.when(F.col("age_minutes") > error_min, F.lit("error"))
              .when(F.col("age_minutes") > warn_min, F.lit("warn")).otherwise(F.lit("pass")))
    return (newest.select(F.lit(table).alias("table_name"), *by, "max_loaded_at",
                          as_of.alias("as_of"), age.alias("age_minutes"))
            .withColumn("status", status))


def range_check(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """``checks`` maps a name to the predicate every row must satisfy.

    A NULL predicate is not counted (NULLs are ``not_null``'s concern).
    """
    counts = df.agg(*[F.count_if(~pred).alias(name)
                      for name, pred in checks.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    long = counts.select(F.expr(f"stack({len(checks)}, {pairs}) as (check_name, failures)"))
    return long.select(F.lit(table).alias("table_name"), "check_name",
                       F.col("failures").cast("long").alias("failures"),
                       _status(F.col("failures")).alias("status"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
