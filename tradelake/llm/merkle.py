"""Merkle manifest of a dataset: a postorder append log and proofs from it.

Rows are the leaves of one tree per group, in the order of an id; the subroots
of the groups are the leaves of a last tree, whose root names the dataset.  A
node is the hash of up to ``arity`` consecutive nodes below it.

* Ranks: rows are range-partitioned and sorted once, so a group with most rows
  spreads over many partitions; counts per partition give every row its rank.
* Builders: one for each aligned run of ``span = arity ** LEVELS`` leaves.  It
  appends every node the moment its last leaf has been appended, so its log is
  the postorder of its subtree.  The roots of the runs are the leaves of the
  next round, and so on; a round is ``span`` times smaller than the one before.
* Addresses: how many nodes are complete before a leaf follows from the sizes of
  the subtrees alone (sum of ``leaf // arity ** level``), so the position of any
  node in the log is a closed form and siblings are read from the log by
  address; nothing is searched and no tree is rebuilt to prove a row.
* Proofs: from the last tree down, each round hands its runs the siblings above
  them; one row of the work is one run, at most ``span`` leaves.

Defined results: nulls in hashed fields are written as ``-``, other values with
their length, so no two rows can be confused.  A null group is a tree of its own
and comes first; null ids come first in their tree; rows with the same id are
ordered by their leaf.  A lone leaf is its own root; an empty table has no rows,
no nodes and no root.  Extra columns change nothing unless they are named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tradelake.llm.common import crc32_sql, stored

ARITY = 8
LEVELS = 3      # tree levels that one builder covers
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = ArrayType(ArrayType(StringType()))


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---- closed forms -----------------------------------------------------------------

def height(leaves: int, arity: int = ARITY) -> int:
    """Levels above the leaves until one node remains."""
    h, reach = 0, 1
    while reach < leaves:
        h, reach = h + 1, reach * arity
    return h


@lru_cache(1 << 16)
def position(level: int, index: int, leaves: int, top: int, arity: int = ARITY) -> int:
    """Place of a node in the log of a tree of ``leaves`` leaves and ``top`` levels."""
    reach = arity ** level
    if (index + 1) * reach <= leaves:       # complete with the leaf ``last``, after its lower levels
        last = (index + 1) * reach - 1
        return sum(last // arity ** j for j in range(top + 1)) + level
    first = next(j for j in range(1, top + 1) if leaves % arity ** j)
    return sum(leaves // arity ** j for j in range(top + 1)) + level - first


@lru_cache(1 << 14)
def siblings(level: int, index: int, leaves: int, top: int, arity: int = ARITY) -> tuple[int, ...]:
    """Log positions of the run that holds a node; -1 stands for the node itself."""
    start = index // arity * arity
    width = -(-leaves // arity ** level)
    return tuple(-1 if i == index else position(level, i, leaves, top, arity)
                 for i in range(start, min(start + arity, width)))


def append_log(leaves: Sequence[str], top: int, arity: int = ARITY) -> list[str]:
    """All nodes of a tree in the order they are completed; the root is the last."""
    log, runs = [], [[] for _ in range(top + 1)]

    def put(node: str, level: int) -> None:
        log.append(node)
        runs[level].append(node)

    for leaf in leaves:
        put(leaf, 0)
        level = 0
        while level < top and len(runs[level]) == arity:
            node = digest(runs[level])
            runs[level].clear()
            level += 1
            put(node, level)
    for level in range(top):                # the last, shorter runs
        if runs[level]:
            put(digest(runs[level]), level + 1)
    return log


def local_path(log: Sequence[str], leaf: int, leaves: int, top: int, arity: int = ARITY) -> list[list[str]]:
    """For each level the nodes of the run around ``leaf``'s ancestor, "" in its own place."""
    return [["" if at < 0 else log[at] for at in siblings(level, leaf // arity ** level, leaves, top, arity)]
            for level in range(top)]


# ---- leaves -----------------------------------------------------------------------

def written(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[written(v) for v in values]), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (tree, ...) with rank (from 0 in its tree) and total (leaves of the
    tree), ordered by ``order``.  No task sees more than its range of the rows."""
    by = ["tree", *order]
    line = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("seq", F.monotonically_increasing_id()), "sorted")
    line = line.withColumn("part", F.shiftright("seq", 33))
    tree = Window.partitionBy("tree")       # one row for each part of a tree
    parts = (line.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
             .select("tree", "part", F.sum("n").over(tree).alias("total"),
                     (F.sum("n").over(tree.orderBy("part")) - F.col("n") - F.col("first")).alias("shift")))
    return (line.join(parts, ["tree", "part"])
            .withColumn("rank", F.col("seq") + F.col("shift")).drop("seq", "part", "shift"))


# ---- the forest ---------------------------------------------------------------------

@dataclass
class Forest:
    """Rounds of builders over trees: every row of a round is one aligned run with
    tree, total, block, rows (round 0 only) and log (its nodes in completion order)."""
    arity: int
    rounds: list[DataFrame] = field(default_factory=list)

    @property
    def span(self) -> int:
        return self.arity ** LEVELS

    def roots(self) -> DataFrame:
        """tree, root: one row for each tree."""
        found = [r.where(F.col("total") <= self.span).select("tree", F.element_at("log", -1).alias("root"))
                 for r in self.rounds]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


def builders(leaves: DataFrame, arity: int, rows: Column | None) -> DataFrame:
    """(tree, rank, total, digest and more) -> one row for each aligned run, with its log.
    ``rows``: what to keep of every leaf, in the order of the run."""
    span = arity ** LEVELS
    one = F.struct("rank", "digest", *([rows.alias("row")] if rows is not None else []))
    runs = (leaves.groupBy("tree", "total", F.floor(F.col("rank") / span).cast("long").alias("block"))
            .agg(F.sort_array(F.collect_list(one)).alias("run")))        # ``span`` leaves at most
    keep = [F.col("run.row").alias("rows")] if rows is not None else []
    runs = runs.select("tree", "total", "block", *keep, F.col("run.digest").alias("leaves"))

    def write(batches):
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            tops = [height(n, arity) if n <= span else LEVELS for n in cols["total"].to_pylist()]
            logs = [append_log(run, top, arity) for run, top in zip(cols["leaves"].to_pylist(), tops)]
            names = [n for n in batch.schema.names if n != "leaves"]
            yield pa.RecordBatch.from_arrays([*[cols[n] for n in names], pa.array(logs, pa.list_(pa.string()))],
                                             [*names, "log"])
    kinds = [f for f in runs.schema.fields if f.name != "leaves"]
    return stored(runs.mapInArrow(write, StructType([*kinds, StructField("log", ArrayType(StringType()))])), "log")


def build(leaves: DataFrame, rows: Column, arity: int = ARITY) -> Forest:
    """All trees of ``leaves`` (tree, rank, total, digest ...); ``rows`` stays with each leaf."""
    forest = Forest(arity)
    while True:
        done = builders(leaves, arity, rows if not forest.rounds else None)
        forest.rounds.append(done)
        more = done.where(F.col("total") > forest.span)
        if more.isEmpty():
            return forest
        leaves = more.select("tree", F.col("block").alias("rank"),
                             F.ceil(F.col("total") / forest.span).cast("long").alias("total"),
                             F.element_at("log", -1).alias("digest"))


def log_nodes(forest: Forest) -> DataFrame:
    """The append log of every tree, one row a node: tree, position, level, digest."""
    out, arity, span = None, forest.arity, forest.span
    for i, done in enumerate(forest.rounds):
        low = i * LEVELS

        def place(batches, low=low):
            for batch in batches:
                for row in batch.to_pylist():
                    leaves, start = row["total"], row["block"] * span      # nodes that this run stands on
                    n = min(leaves - start, span)
                    top = height(leaves, arity) if leaves <= span else LEVELS
                    local = {position(lv, j, n, top, arity): (lv, j)
                             for lv in range(top + 1) for j in range(-(-n // arity ** lv))}
                    real = row["real"]
                    full = height(real, arity)
                    rows = [(row["tree"], position(low + lv, (start // arity ** lv) + j, real, full, arity), low + lv,
                             row["log"][at]) for at, (lv, j) in sorted(local.items()) if low == 0 or lv > 0]
                    cols = list(zip(*rows)) or [[], [], [], []]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                         pa.array(cols[3], pa.string())], ["tree", "position", "level", "digest"])
        sizes = (forest.rounds[0].where("block = 0").select("tree", F.col("total").alias("real")))
        nodes = (done.select("tree", "total", "block", "log").join(sizes, "tree")
                 .mapInArrow(place, "tree string, position long, level long, digest string"))
        out = nodes if out is None else out.unionByName(nodes)
    return out


def proofs(forest: Forest, above: DataFrame) -> DataFrame:
    """row (as kept by ``build``), the other columns of ``above`` and path for every
    leaf.  ``above`` holds for each tree its path (the runs above its root, bottom up).
    A run is a list of node digests with "" in the place of the proven side."""
    arity, span = forest.arity, forest.span
    more = [c for c in above.columns if c not in ("tree", "path")]
    want = None
    for i in reversed(range(len(forest.rounds))):
        done = forest.rounds[i]
        work = done.where(F.col("total") <= span).join(above, "tree")
        if want is not None:
            work = work.unionByName(done.where(F.col("total") > span).join(want, ["tree", "block"]))
        last = i == 0

        def down(batches, last=last):
            for batch in batches:
                at = {n: k for k, n in enumerate(batch.schema.names)}
                blocks, totals = batch.column(at["block"]).to_pylist(), batch.column(at["total"]).to_pylist()
                for k in range(batch.num_rows):
                    n = min(totals[k] - blocks[k] * span, span)
                    top = height(totals[k], arity) if totals[k] <= span else LEVELS
                    log, upper = batch.column(at["log"])[k].as_py(), batch.column(at["path"])[k].as_py()
                    paths = pa.array([local_path(log, j, n, top, arity) + upper for j in range(n)],
                                     pa.list_(pa.list_(pa.string())))
                    same = pa.array([0] * n, pa.int64())
                    cols = [batch.column(at[c]).slice(k, 1).take(same) for c in more]
                    if last:
                        own = batch.column(at["rows"]).slice(k, 1).flatten()
                        yield pa.RecordBatch.from_arrays([own, *cols, paths], ["row", *more, "path"])
                    else:
                        tree = batch.column(at["tree"]).slice(k, 1).take(same)
                        under = pa.array(range(blocks[k] * span, blocks[k] * span + n), pa.int64())
                        yield pa.RecordBatch.from_arrays([tree, under, *cols, paths], ["tree", "block", *more, "path"])
        extra = [StructField(c, above.schema[c].dataType) for c in more]
        if last:
            kind = StructType([StructField("row", done.schema["rows"].dataType.elementType), *extra,
                               StructField("path", PATH)])
            return work.mapInArrow(down, kind)
        kind = StructType([StructField("tree", StringType()), StructField("block", LongType()), *extra,
                           StructField("path", PATH)])
        want = stored(work.mapInArrow(down, kind), "paths")


@dataclass
class Manifest:
    rows: Forest        # one tree per group
    groups: Forest      # the tree of their roots


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
             keep: dict[str, Column] | None = None, arity: int = ARITY) -> Manifest:
    """Trees over all rows of ``docs``.  ``keep``: named expressions over ``docs`` that
    stay with each leaf, beside ``id``, for the rows of ``prove``."""
    named = {"id": F.col(order), **(keep or {})}
    rows = docs.select(written(F.col(group)).alias("tree"), F.col(group).alias("grp"),
                       leaf(*[F.col(f) for f in fields]).alias("digest"),
                       F.struct(*[v.alias(k) for k, v in named.items()]).alias("row"))
    rows = rows.withColumn("id", F.col("row.id"))
    line = ranked(stored(rows, "leaves"), ["id", "digest"])     # texts are hashed once, not for the ranges' sample too
    kept = F.struct("digest", "grp", F.col("row"))
    forest = build(line, kept, arity)
    names = (forest.rounds[0].where("block = 0").select("tree", F.element_at("rows", 1)["grp"].alias("grp")))
    subroots = (forest.roots().join(names, "tree")
                .select(F.lit("").alias("tree"), "grp", F.col("root").alias("digest"), F.col("tree").alias("of")))
    top = build(ranked(subroots, ["grp"]), F.struct(F.col("of"), F.col("digest")), arity)
    return Manifest(forest, top)


def prove(made: Manifest) -> DataFrame:
    """For every row: what was kept with it, leaf, subroot, root and path (its runs of
    siblings, bottom up, "" in its own place)."""
    start = made.groups.roots().select("tree", "root", F.array().cast(PATH).alias("path"))
    above = (proofs(made.groups, start)
             .select(F.col("row.of").alias("tree"), F.col("row.digest").alias("subroot"), "root", "path"))
    out = proofs(made.rows, stored(above, "group-paths"))
    return out.select("row.row.*", F.col("row.digest").alias("leaf"), "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.flatten(path), ""), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, start, lambda node, run: F.sha2(
        F.array_join(F.transform(run, lambda x: F.when(x == "", node).otherwise(x)), ""), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tamper_report(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, each folded from its leaf after every third text
    (by hash of the id) has been lower-cased."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    changed = leaf(*[text if f == "text" else F.col(f) for f in FIELDS])
    out = prove(manifest(docs, keep={"changed": F.when(hit, changed)}))
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    return (out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                       proof_digest(F.col("path")).alias("proof_sha256"), again.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def report_sql() -> str:
    def part(v):
        return f"coalesce(octet_length(encode({v}::varchar))::varchar || ':' || {v}::varchar, '-')"

    def leaf_sql(text):
        return "sha256(" + " || ".join(part(text if f == "text" else f) for f in FIELDS) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    up = """select tree, level + 1, idx // 8, sha256(string_agg(h, '' order by idx)), null::bigint, null::varchar
            from (select *, count(*) over (partition by tree) as width from {0}) where width > 1 group by tree, level, idx // 8"""
    return f"""
    with recursive base as (
        select doc_id, lang, {leaf_sql('text')} as leaf, {leaf_sql(lowered)} as low, {crc32_sql('doc_id::varchar')} % 3 = 0 as hit from documents),
    ranks as (select *, coalesce(lang, '') || case when lang is null then '-' else '+' end as tree,
                     row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank from base),
    nodes(tree, level, idx, h, doc_id, lang) as (
        select tree, 0, rank, leaf, doc_id, lang from ranks union all {up.format('nodes')}),
    subroots as (select tree, h as subroot, level as top from nodes n where level = (select max(level) from nodes m where m.tree = n.tree)),
    tops as (select s.*, row_number() over (order by g.lang nulls first) - 1 as place
             from subroots s join (select distinct tree, lang from ranks) g using (tree)),
    crown(tree, level, idx, h, a, b) as (
        select '', 0, place, subroot, null::bigint, null::varchar from tops union all {up.format('crown')}),
    crest as (select h as root, level as top from crown where level = (select max(level) from crown)),
    every as (select tree, level, idx, h from nodes union all
              select t.tree, t.top + c.level, c.idx, c.h from crown c, tops t where c.level > 0),
    runs as (select r.tree, r.rank, r.doc_id, n.level, n.idx, n.h, false as upper from ranks r join tops t using (tree)
             join nodes n on n.tree = r.tree and n.level < t.top and n.idx // 8 = (r.rank // (8 ** n.level)::bigint) // 8
                          and n.idx <> r.rank // (8 ** n.level)::bigint
             union all
             select r.tree, r.rank, r.doc_id, t.top + c.level, c.idx, c.h, true from ranks r join tops t using (tree), crown c, crest
             where c.level < crest.top and c.idx // 8 = (t.place // (8 ** c.level)::bigint) // 8 and c.idx <> t.place // (8 ** c.level)::bigint),
    proof as (select tree, rank, sha256(string_agg(h, '' order by level, idx)) as p from runs group by tree, rank),
    fold(tree, rank, level, h) as (
        select tree, rank, 0, case when hit then low else leaf end from ranks
        union all
        select f.tree, f.rank, f.level + 1,
               sha256(coalesce(string_agg(r.h, '' order by r.idx) filter (r.idx < w.own), '') || f.h
                      || coalesce(string_agg(r.h, '' order by r.idx) filter (r.idx > w.own), ''))
        from fold f join tops t using (tree), crest,
             lateral (select case when f.level < t.top then f.rank // (8 ** f.level)::bigint
                             else t.place // (8 ** (f.level - t.top))::bigint end as own) w
             left join runs r on r.tree = f.tree and r.rank = f.rank and r.level = f.level
        where f.level < t.top + crest.top
        group by f.tree, f.rank, f.level, f.h, w.own)
    select r.doc_id, r.leaf, t.subroot, crest.root,
           coalesce(p.p, sha256('')) as proof_sha256, f.h as folded_root, f.h = crest.root as verified
    from ranks r join tops t using (tree), crest
         join fold f on f.tree = t.tree and f.rank = r.rank and f.level = t.top + crest.top
         left join proof p on p.tree = r.tree and p.rank = r.rank
    """
