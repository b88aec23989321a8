"""Silver and gold as catalog tables under the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradelake.session import scratch_path


def ensure_database(spark: SparkSession, name: str) -> None:
    loc = scratch_path(spark, "warehouse", f"{name}.db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{loc}'")


def write_table(spark: SparkSession, df: DataFrame, db: str, table: str,
                partition_by: list[str] | None = None) -> DataFrame:
    """Rebuild ``db.table`` (the gold materialisation), then read it back.

    Without ``partition_by``, or where the table is new, it is written whole.
    With ``partition_by`` an existing table keeps the partitions that ``df``
    does not hold: a rebuild of a few symbols replaces their directories only.
    """
    ensure_database(spark, db)
    name = f"{db}.{table}"
    path = scratch_path(spark, "warehouse", f"{db}.db", table)
    w = df.write.mode("overwrite")
    if partition_by and spark.catalog.tableExists(name):
        w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
        if spark.conf.get("spark.sql.catalogImplementation") == "hive":    # its catalog lists partitions
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        return spark.table(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def list_tables(spark: SparkSession, db: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(db)]
