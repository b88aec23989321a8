"""Bronze history bucketed on the trade key, for incremental replay dedup.

A day of new trades has to be compared with every trade seen before.  The history
lies in a table that is bucketed on (symbol, trade_id): a batch is shuffled to the
buckets, the history is read where it lies and is never shuffled.  Keys are
near-unique, so buckets are even also where one symbol holds most trades; a replayed
trade is reduced to one copy before it is shuffled.

A batch adds only the copies that beat all stored ones (``fresh_copies``), so a key
has seldom more than one stored row; ``current`` picks the best one at reading, again
without a shuffle.  A replayed batch adds nothing: its copies are no better than
themselves.  An append that is lost midway leaves no committed file.

The number of buckets belongs to the folder.  Choose it for the size the history is
to reach (a bucket is one task: 100 TB in 400,000 buckets are 256 MB each); another
number needs a rewrite into another folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.operators.silver import DEDUP_KEYS, DEDUP_ORDER, dedup_trades
from tradelake.schema import BRONZE_COLUMNS, BRONZE_SCHEMA


class TradeHistory:
    """The bucketed table ``name`` at ``path``; it is declared in the session's
    catalog where the catalog does not know it yet."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BRONZE_SCHEMA)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                  f"CLUSTERED BY ({', '.join(DEDUP_KEYS)}) SORTED BY ({', '.join(DEDUP_KEYS)}) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}/buckets-{buckets}'")

    def rows(self) -> DataFrame:
        """All stored copies."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def fresh_copies(self, batch: DataFrame) -> DataFrame:
        """The best copy of each key of ``batch``, unless a stored one is as good
        or better.  Rows without a key are left out, as in ``dedup_trades``."""
        # shuffled once more, to as many partitions as there are buckets: by itself the
        # planner would bring the history to the batch's partitions where these are more.
        # An anti join would be pushed below that, hence the best stored copy and a filter.
        new = dedup_trades(batch.select(*BRONZE_COLUMNS)).repartition(self.buckets, *DEDUP_KEYS)
        best = self.rows().groupBy(*DEDUP_KEYS).agg(F.min(_order()).alias("_best"))
        # the hint keeps the history where it lies, also while it is small
        return (new.join(best.hint("merge"), DEDUP_KEYS, "left")
                .where(F.col("_best").isNull() | (_order() < F.col("_best"))).drop("_best"))

    def add(self, batch: DataFrame) -> None:
        """Store what ``batch`` adds: the join leaves a bucket in one task, which writes
        one file of it."""
        self.fresh_copies(batch).select(*BRONZE_COLUMNS).write.mode("append").insertInto(self.name)

    def current(self) -> DataFrame:
        """One row per (symbol, trade_id): ``dedup_trades`` of all batches so far."""
        return dedup_trades(self.rows())

    def repeated(self) -> DataFrame:
        """Keys that are stored more than once, with their number of copies, by a
        count inside the buckets."""
        return (self.rows().groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") > 1))


def _order() -> Column:
    """The dedup order as one comparable value, nulls last."""
    return F.struct(*[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("value")).alias(c) for c in DEDUP_ORDER])
