"""Connected components by contraction, for links between millions of nodes.

Each round every node picks the neighbour (or itself) that comes first in a
random order drawn anew for the round; nodes are replaced by their pick and
loops and repeated links vanish.  The expected number of remaining nodes falls
by a constant factor, also on long chains.  All steps are equi-joins of stored
tables, so AQE can split the rows of a hot node, and nothing is collected but
the number of links that remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import stored


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``links`` (a, b) -> (node, root), one row per node that has a link to
    another one; ``root`` is the same for all nodes of a component and is one
    of them.  Loops, repeated links and either direction are fine; links with
    a null end are ignored.  Empty links give an empty frame."""
    kind = links.schema["a"].dataType
    links = (links.where(F.col("a") != F.col("b"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = stored(links, "links")
    labels = None
    for rnd in range(max_rounds):
        if links.isEmpty():
            break
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(rnd), c).alias("h"), c.alias("n"))
        picks = (both.groupBy(F.col("a").alias("node")).agg(F.min(order(F.col("b"))).alias("m"))
                 .select("node", F.least(order(F.col("node")), F.col("m"))["n"].alias("to")))
        picks = stored(picks, "picks")
        if labels is None:
            labels = picks.select("node", F.col("to").alias("root"))
        else:
            labels = stored(labels.join(picks.withColumnRenamed("node", "root"), "root", "left")
                            .select("node", F.coalesce("to", "root").alias("root")), "labels")
        moved = (links.join(picks.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                 .join(picks.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                 .where(F.col("x") != F.col("y"))
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        links = stored(moved, "links")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if labels is None:
        return links.sparkSession.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    return labels
