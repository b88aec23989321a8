"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import new_scratch_path

# Words everywhere in this package: runs of anything but the ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; workers are told where this package lies."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Put this package on the Python workers' path (a no-op where it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """``df`` written as Parquet (with the writer's ``options``) to the shared folder and read
    back: cuts the lineage, so a lost executor costs a re-read and not a re-run."""
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, written and read back, and without the tables that
    were stored on the way: for jobs whose intermediates outgrow their result."""
    token = _MADE.set(made := [])
    try:
        out = make()
        _MADE.reset(token)
        return stored(out, name)
    finally:
        if _MADE.get() is made:
            _MADE.reset(token)
        if made:
            hadoop = SparkSession.active().sparkContext
            for path in made:
                p = hadoop._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(hadoop._jsc.hadoopConfiguration()).delete(p, True)


def clear_name(taken, base: str) -> str:
    """A column name that none of ``taken`` clashes with (case-insensitive)."""
    low = {c.lower() for c in taken}
    while base.lower() in low:
        base = "_" + base
    return base


def text_or_empty(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII string, bit by bit (reversed polynomial)."""
    polynomial = 0xEDB88320     # fixed value
    bit = f"lambda v, i: case when v % 2 = 1 then xor(v // 2, {polynomial}) else v // 2 end"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint)"
    return f"xor(list_reduce(list_prepend({0xFFFFFFFF}::bigint, {codes}), {byte}), {0xFFFFFFFF})"
