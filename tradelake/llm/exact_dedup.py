"""Exact duplicates with a split for heavy hitters.

Every text is reduced to its SHA-256 and a 64-bit check hash; two texts are
equal when both agree.  A Misra-Gries summary (Spark's frequent-items sketch: a
bounded set of counters that are all lowered when the set is full) names the
few digests that may be frequent.  It is built per task, merged in ``merges``
groups and then once, so no step sees more than a bounded number of counters.
Its counts are not used: an exact second pass over the digests counts every
candidate and finds the row that stays.  These verified winners, at most
``counters`` rows, are broadcast and decide their copies on the map side; no
copy of a frequent text is shuffled.  All other digests go through one ordinary
shuffle, where no group is larger than what the summary can miss (about
``5 / counters`` of all rows).  The result does not depend on what the summary
finds, only the way a row takes does.

Defined results: a null text counts as empty; a null id comes before every
other id, so it names a group only where all its ids are null.  Of rows that
repeat the id that stays exactly one is kept.  An empty table gives an empty
result; other columns, whatever their names, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import clear_name, stored, text_or_empty

COUNTERS = 256
MERGES = 64


def digests(docs: DataFrame, order: str, text: Column | None, uid: Column) -> DataFrame:
    """One row per row of ``docs``: uid, id, digest (binary SHA-256), check."""
    text = text_or_empty("text") if text is None else F.coalesce(text, F.lit(""))
    return docs.select(uid.alias("uid"), F.col(order).alias("id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), F.xxhash64(text).alias("check"))


def frequent(rows: DataFrame, counters: int = COUNTERS, merges: int = MERGES) -> DataFrame:
    """Digests that may be frequent, ``counters`` at most: merged Misra-Gries summaries."""
    parts = (rows.select(F.lower(F.hex("digest")).alias("item"), (F.spark_partition_id() % merges).alias("part"))
             .groupBy("part").agg(F.expr(f"approx_top_k_accumulate(item, {counters})").alias("summary")))
    return (parts.groupBy((F.col("part") >= 0).alias("all")).agg(F.expr(f"approx_top_k_combine(summary, {counters})").alias("summary"))
            .select(F.explode(F.expr(f"approx_top_k_estimate(summary, {counters})")).alias("e"))
            .select(F.unhex("e.item").alias("digest")))


def winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact (digest, check, n, top, last) of the frequent digests with more than one
    row: their count, greatest id and the row that stays."""
    candidates = stored(frequent(rows, counters), "candidates")
    found = rows.join(F.broadcast(candidates), "digest")        # bounded by ``counters``
    return (found.groupBy("digest", "check")
            .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "uid")).alias("top"))
            .where("n > 1").select("digest", "check", "n", F.col("top.id").alias("keep"), F.col("top.uid").alias("last")))


def decided(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``rows`` of ``digests`` (stored) with keep (id of the row that stays), n (rows
    of the group) and kept."""
    heavy = stored(winners(rows, counters), "winners")
    by = ["digest", "check"]
    copies = (rows.join(F.broadcast(heavy), by)
              .select("uid", "id", "digest", "keep", "n", (F.col("uid") == F.col("last")).alias("kept")))
    group = Window.partitionBy(*by)
    first = group.orderBy(F.col("id").desc_nulls_last(), F.col("uid").desc())
    rest = (rows.join(F.broadcast(heavy), by, "left_anti")
            .select("uid", "id", "digest", F.max("id").over(group).alias("keep"),
                    F.count(F.lit(1)).over(group).alias("n"), (F.row_number().over(first) == 1).alias("kept")))
    return copies.unionByName(rest)


def exact_duplicates(docs: DataFrame, order: str = "doc_id", text: Column | None = None,
                     counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: its ``order`` column, keep_id, group_size, kept
    and text_sha256.  ``text`` is the normalised text (default: the column as it is)."""
    rows = stored(digests(docs, order, text, F.monotonically_increasing_id()), "digests")
    return (decided(rows, counters)
            .select(F.col("id").alias(order), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
                    "kept", F.lower(F.hex("digest")).alias("text_sha256")))


def drop_copies(docs: DataFrame, order: str = "doc_id", text: Column | None = None,
                counters: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that with the greatest
    ``order``; columns as they were."""
    uid = clear_name(docs.columns, "uid")
    marked = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "numbered")
    rows = digests(marked, order, text, F.col(uid))
    gone = decided(stored(rows, "digests"), counters).where("not kept").select(F.col("uid").alias(uid))
    return marked.join(gone, uid, "left_anti").select(*docs.columns)


def duplicates_sql() -> str:
    return """
    select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
           row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
           sha256(coalesce(text, '')) as text_sha256
    from documents window g as (partition by coalesce(text, ''))
    """
