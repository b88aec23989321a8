"""Releases: all silver and gold tables of one build, published by one switch.

A build writes its tables below a version of its own, where no reader looks.
After the checks have passed on what was written, the version is published by
creating one empty file whose *name* carries the version; readers take the
newest name.  Creating a file is atomic on HDFS and on object stores alike, so
every table changes at the same moment, a crash before it leaves the old
version as it was, and a reader that has looked up a version keeps it.

Tables lie in directories of one period: a day, or a month or year for a feed with
few trades a day (thousands of tiny directories would cost more than they prune).
Each version also holds a small table of row counts by (table, symbol, period) and
the largest value of a measure in each, from which serving queries learn how many
of the newest periods they need.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.session import scratch_path
from tradelake.sources.tables import ensure_database

PERIOD = "period"     # directory of a row: the first day of its day, month or year


@dataclass(frozen=True)
class Spec:
    """How a table is stored: database, event time (its period is the directory), the
    order within files and the measure whose maximum of each period is kept."""
    db: str
    time: str
    measure: str
    sort: tuple[str, ...]


SPECS = {
    "stg_trades": Spec("silver", "traded_at", "volume_usd", ("symbol", "traded_at")),
    "stg_ohlcv": Spec("silver", "candle_time", "volume_usd", ("symbol", "candle_time")),
    "mart_vwap": Spec("gold", "candle_time", "close", ("symbol", "candle_time")),
    "mart_volatility": Spec("gold", "candle_time", "close", ("symbol", "candle_time")),
    "mart_whale_trades": Spec("gold", "traded_at", "volume_usd", ("symbol", "traded_at")),
}


class Releases:
    """The versions below one folder (default: one folder for each feed name)."""

    def __init__(self, spark: SparkSession, feed: str, root: str | None = None, grain: str = "day"):
        self.spark, self.feed, self.grain = spark, feed, grain
        self.root = (root or scratch_path(spark, "releases", feed)).rstrip("/")

    # ---- files ----------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def path(self, version: str, *parts: str) -> str:
        return "/".join([self.root, "versions", version, *parts])

    # ---- writing --------------------------------------------------------------

    def new_version(self) -> str:
        return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def stage(self, version: str, name: str, df: DataFrame) -> DataFrame:
        """Write a table of a version and read it back.  Rows are dealt by period, and
        AQE splits a busy one by its size, so that no task writes a hot period alone."""
        spec = SPECS[name]
        rows = df.withColumn(PERIOD, F.to_date(F.date_trunc(self.grain, spec.time)))
        df.limit(0).write.parquet(self.path(version, "_schemas", name))
        (rows.hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, *spec.sort)
         .write.partitionBy(PERIOD).parquet(self.path(version, name)))
        made = self.table(name, version)
        (made.groupBy("symbol", PERIOD).agg(F.count(F.lit(1)).alias("n"), F.max(spec.measure).alias("top"))
         .withColumn("table_name", F.lit(name)).write.mode("append").partitionBy("table_name")
         .parquet(self.path(version, "_periods")))
        return made

    def publish(self, version: str) -> None:
        """Make ``version`` the one that readers take: one atomic creation."""
        fs, p = self._fs(f"{self.root}/published/{self.new_version()}={version}")
        fs.create(p, False).close()

    def prune(self, keep: int = 2) -> list[str]:
        """Remove versions that are neither among the last ``keep`` published ones nor
        newer than the current one (a build under way)."""
        kept = [n.split("=", 1)[1] for n in self._names(f"{self.root}/published")][-keep:]
        gone = [v for v in self._names(f"{self.root}/versions") if kept and v not in kept and v < kept[-1]]
        for version in gone:
            fs, p = self._fs(self.path(version))
            fs.delete(p, True)
        return gone

    # ---- reading --------------------------------------------------------------

    def current(self) -> str | None:
        names = self._names(f"{self.root}/published")
        return names[-1].split("=", 1)[1] if names else None

    def _at(self, version: str | None) -> str:
        version = version or self.current()
        if version is None:
            raise LookupError(f"nothing is published in {self.root}")
        return version

    def tables(self, version: str | None = None) -> list[str]:
        return self._names(self.path(self._at(version), "_schemas"))

    def table(self, name: str, version: str | None = None) -> DataFrame:
        """A table of a version (default: the published one) with its period column."""
        version = self._at(version)
        schema = self.spark.read.parquet(self.path(version, "_schemas", name)).schema
        return self.spark.read.schema(schema.add(PERIOD, "date")).parquet(self.path(version, name))

    def periods(self, name: str, version: str | None = None) -> DataFrame:
        """symbol, period, n, top of a table: one row for each symbol and period."""
        schema = "symbol string, period date, n long, top double, table_name string"
        return (self.spark.read.schema(schema).parquet(self.path(self._at(version), "_periods"))
                .where(F.col("table_name") == name).drop("table_name"))

    def register(self, version: str | None = None) -> list[str]:
        """Views ``db.table`` over a version, for SQL users; each is replaced whole."""
        version = self._at(version)
        out = []
        for name in self.tables(version):
            db = SPECS[name].db
            ensure_database(self.spark, db)
            columns = ", ".join(f"`{c}`" for c in self.spark.read.parquet(self.path(version, "_schemas", name)).columns)
            rows = f"{PERIOD} FROM parquet.`{self.path(version, name)}`"
            if not any(x.startswith(f"{PERIOD}=") for x in self._names(self.path(version, name))):    # an empty table
                rows = f"CAST(NULL AS DATE) AS {PERIOD} FROM parquet.`{self.path(version, '_schemas', name)}`"
            self.spark.sql(f"CREATE OR REPLACE VIEW {db}.{self.feed}_{name} AS SELECT {columns}, {rows}")
            out.append(f"{db}.{self.feed}_{name}")
        return out


# ---- newest periods first ------------------------------------------------------------

def periods_needed(held: DataFrame, n: int) -> list[dt.date]:
    """The newest periods that together hold ``n`` rows.  One row a period is added up;
    every period holds a row at least, so at most ``n`` dates come to the driver."""
    newer = Window.orderBy(F.col(PERIOD).desc()).rowsBetween(Window.unboundedPreceding, -1)
    line = (held.where(F.col(PERIOD).isNotNull()).groupBy(PERIOD).agg(F.sum("n").alias("n"))
            .withColumn("newer", F.coalesce(F.sum("n").over(newer), F.lit(0))).where(F.col("newer") < n))
    return [r[0] for r in line.select(PERIOD).collect()]


def newest(releases: Releases, name: str, n: int, symbol: str | None = None, keep=None,
           version: str | None = None) -> DataFrame:
    """A part of a table that holds its newest ``n`` rows (of ``symbol``, of those with
    ``keep``): whole periods from the newest back, as static partition filters.  Counts
    of each period say which are needed, without those a sparse symbol has no row in;
    with ``keep``, whose count they do not know, four times as many rows are read
    while fewer than ``n`` fit."""
    version = releases._at(version)
    held, table = releases.periods(name, version), releases.table(name, version)
    if symbol is not None:
        held, table = held.where(F.col("symbol") == symbol), table.where(F.col("symbol") == symbol)
    if keep is not None:
        table = table.where(keep)
    every = held.where(F.col(PERIOD).isNotNull()).select(PERIOD).distinct().count() if keep is not None else 0
    want = n
    while True:
        needed = periods_needed(held, want)
        part = table.where(F.col(PERIOD).isin(needed))
        if keep is None or len(needed) == every or part.limit(n).count() >= n:
            return part.drop(PERIOD)
        want *= 4


def newest_of_each(releases: Releases, name: str, n: int, version: str | None = None) -> DataFrame:
    """A part of a table that holds the newest ``n`` rows of every symbol.  Symbols with
    long gaps need many periods; only their rows of those are read on."""
    version = releases._at(version)
    newer = Window.partitionBy("symbol").orderBy(F.col(PERIOD).desc()).rowsBetween(Window.unboundedPreceding, -1)
    start = (releases.periods(name, version).withColumn("newer", F.coalesce(F.sum("n").over(newer), F.lit(0)))
             .where(F.col("newer") < n).groupBy("symbol").agg(F.min(PERIOD).alias("start")))
    oldest = start.agg(F.min("start")).first()[0]
    table = releases.table(name, version)
    part = table.where(F.col(PERIOD) >= F.lit(oldest)) if oldest is not None else table.where(F.lit(False))
    return part.join(start, "symbol").where(F.col(PERIOD) >= F.col("start")).drop(PERIOD, "start")


def since_newest(releases: Releases, name: str, days_back: int, version: str | None = None) -> DataFrame:
    """The rows of each symbol from ``days_back`` days before its newest period on."""
    version = releases._at(version)
    first = F.to_date(F.date_trunc(releases.grain, F.date_sub(F.max(PERIOD), days_back)))
    start = releases.periods(name, version).groupBy("symbol").agg(first.alias("start"))
    oldest = start.agg(F.min("start")).first()[0]
    table = releases.table(name, version)
    part = table.where(F.col(PERIOD) >= F.lit(oldest)) if oldest is not None else table.where(F.lit(False))
    return part.join(start, "symbol").where(F.col(PERIOD) >= F.col("start")).drop(PERIOD, "start")


def largest(releases: Releases, name: str, k: int, version: str | None = None) -> DataFrame:
    """A part of a table that holds its ``k`` rows with the largest measure: only
    periods whose maximum reaches the ``k``-th largest one can hold one of them."""
    version = releases._at(version)
    tops = releases.periods(name, version).groupBy(PERIOD).agg(F.max("top").alias("top"))
    bound = tops.orderBy(F.col("top").desc_nulls_last()).limit(k).agg(F.min("top")).first()[0]
    table = releases.table(name, version)
    if bound is None:
        return table.drop(PERIOD)
    held = [r[0] for r in tops.where(F.col("top") >= bound).select(PERIOD).collect()]    # dates only
    return table.where(F.col(PERIOD).isin(held)).drop(PERIOD)
