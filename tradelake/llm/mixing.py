"""Mixing sources to target weights.

Targets by capped water-filling: the wanted total is shared by weight, a
source stops at ``max_epochs`` times its size, and the excess is shared again
by weight among the others until none is above.  The outcome of that loop is
one level ``x`` with target = min(cap, x * weight); sources in the order of
cap / weight reach their caps one after the other, so running sums over the
source table (one row per source) give the level directly.

A document is taken ``floor(target / source size)`` times, and once more if it
lies in the seeded share that makes up the fraction: documents stand in a
random but fixed order (MD5 of seed and id) and are taken until their sizes
reach the rest of the target; the document at the border is taken in part, so
a source meets its target to the word.
The running sum is in two levels, over hash ranges and inside a range, so a
source with most of the rows is summed by many tasks.

Only DataFrame functions are used.  Defined results: a null text has size 0; a
null source is one source, last in order; empty documents take part with size
0; a source of size 0 has target 0; repeated rows are separate rows with a
fixed order; more is wanted than all caps: every source gets its cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm.common import WORD_PATTERN, clear_name, stored

RANGES = 4096  # hash ranges of a source: 3 hex digits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: list[int], share: float, max_epochs: float) -> DataFrame:
    """(source, source_size) -> source, source_size, target.  Sources are
    ordered by code point (as UTF-8 bytes), null last, and take the weights in turn."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    cap = F.col("source_size") * F.lit(float(max_epochs))
    named = (sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                       (turn + 1).cast("int")))
             .withColumn("cap", cap))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (named.withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("level", (F.col("wanted") - F.col("full")) / F.col("open")))
    # levels rise while they fill their source and fall after that: the largest
    # of those that do not fill it is that of the first such source
    settled = levels.withColumn(
        "x", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything))
    return settled.select("source", "source_size",
                          F.when(F.col("x").isNull(), F.col("cap"))
                          .otherwise(F.least("cap", F.col("x") * F.col("weight"))).alias("target"))


def taken_sizes(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0,
                seed: str = "mix-1", carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, source, text) -> doc_id, size, source_size, target,
    copies, taken, and the columns named by ``carry`` (unique row keys)."""
    order = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                              word_count(F.col("text").cast("string")).alias("size"), order.alias("place"),
                              *[F.col(c) for c in carry]), "sizes")
    rows = rows.withColumn("range", F.substring("place", 1, 3))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ranges = stored(ranges, "ranges")  # a row for each source and hash range: 4,096 for a source at most
    sources = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(sources, list(weights), share, max_epochs)
    up_to = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.withColumn("before", F.coalesce(F.sum("range_size").over(up_to), F.lit(0)))
              .join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
              .select(F.col("source").alias("name"), F.col("range").alias("at"), "before", "source_size", "target"))
    starts = stored(starts, "starts")
    inside = (Window.partitionBy("source", "range").orderBy("place", "doc_id", "size", *carry)
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("name")) & (F.col("range") == F.col("at"))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - F.col("whole") * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.col("inside")))
    return (summed.withColumn("whole", whole.cast("long")).withColumn("part", part.cast("long"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part", *carry))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row as often as it is taken whole, and the first
    words of the one document of a source that is taken in part.  Columns as
    they were; ``n_chars`` follows the text."""
    uid, words = clear_name(docs.columns, "uid"), clear_name(docs.columns, "words")
    rows = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "mix-input")
    size = F.col("size")
    times = F.col("whole") + F.when(F.col("part") == size, 1).otherwise(0)
    copies = F.concat(F.array_repeat(size, times.cast("int")),
                      F.when(F.col("part").between(1, size - 1), F.array("part")).otherwise(F.array().cast("array<bigint>")))
    copies = F.when(size > 0, copies).otherwise(F.array(F.lit(0).cast("long")))  # empty documents stay, once
    taken = taken_sizes(rows, carry=(uid,), **options)
    taken = taken.select(uid, F.explode(F.transform(copies, lambda w: F.when(w < size, w))).alias(words))
    many = rows.join(taken, uid)
    cut = {c: F.when(F.col(words).isNull(), F.col(c)).otherwise(
        first_words(F.col("text"), F.col(words)).cast(docs.schema[c].dataType)) for c in docs.columns if c.lower() == "text"}
    many = many.withColumns(cut)
    follow = {c: F.when(F.col(words).isNull(), F.col(c)).otherwise(
        F.char_length("text").cast(docs.schema[c].dataType)) for c in docs.columns if c.lower() == "n_chars"}
    return (many.withColumns(follow) if follow else many).select(*docs.columns)


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    blank, word = r"[\x20\x09-\x0D]", WORD_PATTERN[:-1]
    pieces = F.split(F.regexp_replace(text, f"^{blank}+", ""), f"(?<={blank})(?={word})")
    return F.regexp_replace(F.array_join(F.slice(pieces, 1, n.cast("int")), ""), f"{blank}+$", "")


def mixing_sql(weights=(3, 1, 2), share=1.5, max_epochs=2.0, seed="mix-1") -> str:
    """The same rows in DuckDB."""
    return rf"""
with sized as (
  select doc_id, source, md5('{seed}:' || coalesce(cast(doc_id as varchar), 'null')) as place,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, list_extract({[float(w) for w in weights]},
                ((row_number() over (order by source is null, source) - 1) % {len(weights)} + 1)::int) as weight,
         source_size * {float(max_epochs)}::double as cap
  from sources),
levels as (
  select *, (sum(source_size) over ()::double * {float(share)}::double - coalesce(sum(cap) over b, 0))
            / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
  from weighted
  window b as (order by cap / weight, source is null, source
               rows between unbounded preceding and 1 preceding)),
settled as (select *, max(case when level * weight <= cap then level end) over () as x from levels),
targets as (
  select source, source_size, case when x is null then cap else least(cap, x * weight) end as target from settled),
placed as (
  select doc_id, size, source_size, target,
         case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole,
         coalesce(sum(size) over (partition by s.source order by place, doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, floor(target - whole * source_size)::bigint - before)))::bigint as taken
from placed"""
