"""Embedding near-duplicates on a robust-pruned flat graph.

Bit-equal vectors are collapsed first.  Vectors of different lengths never
meet: every length has clusters of its own.  Centroids are fitted on a bounded
sample; every vector goes to its ``overlap`` nearest clusters, so clusters are
overlapping shards (a length of few vectors is one shard).  Each shard builds a flat graph: candidates by similarity,
robust pruning (a neighbour is kept unless a kept one is clearly nearer to it),
reverse edges.  Adjacency lists of all shards are united by vector, and each
shard then searches the united graph for all its vectors: a greedy beam from
several medoids and the vector itself, then a range expansion that follows
every neighbour of what lies near the threshold.  Similarities are cosines in double precision, so no
link is below the threshold.  Recall is audited against brute force for a
bounded sample of vectors, over all links and as the mean of the vectors' own
shares (so that a large group does not hide lost small pairs); while either is
under ``min_recall``, the search is repeated with more overlap and wider beams.

A shard of more than ``shard_limit`` vectors (one hot group, say) is split into
blocks, and every two blocks meet in a task of their own.  A pair is counted
by one task only, that of the smallest cluster both belong to, so counts and
links to each vector's local root leave a task, never the pairs.  A pair without
a common cluster is not found, nor one that only a task of a larger common
cluster finds; more overlap, not wider beams, helps against the former.

Defined results: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing and is its own component; vectors of
different lengths do not link; repeated rows are separate rows; a repeated vec_id keeps all
its rows; other columns are ignored.  Empty input gives empty output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import stored
from tradelake.llm.components import connected_components

# A shard's number: vector length times this, plus the cluster.
LENGTH_STEP = 1 << 32


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def matrix(column) -> np.ndarray:
    """A list column without nulls and of one length as a matrix."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) if len(c) else np.empty((0, 0))


def by_length(batch: pa.RecordBatch | pa.Table, column: str = "v"):
    """(length, the rows whose list has that length) for every length in ``batch``."""
    sizes = pc.list_value_length(batch[column])
    for length in pc.unique(sizes).to_pylist():
        yield length, batch.filter(pc.equal(sizes, length))


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        near = (sample @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-300), c)
    return c


def robust_prune(x: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For every vector the candidates (nearest first, -1 for none) that stay: the
    nearest one, then any that no kept one is ``alpha`` times nearer to."""
    n, c = cand.shape
    out = np.full((n, degree), -1, np.int64)
    for at in range(0, n, 256):
        rows = slice(at, min(n, at + 256))
        own = x[np.maximum(cand[rows], 0)]
        between = np.einsum("ncd,nmd->ncm", own, own)
        alive, kept = cand[rows] >= 0, np.zeros(len(own), np.int64)
        dist = 1.0 - sims[rows]  # half the squared distance of unit vectors
        for j in range(c):
            take = alive[:, j] & (kept < degree)
            if not take.any():
                continue
            who = np.nonzero(take)[0]
            out[at + who, kept[who]] = cand[rows][who, j]
            kept[who] += 1
            covered = alpha * (1.0 - between[who, j, :]) <= dist[who]
            alive[who] &= ~covered
    return out


def build_graph(x: np.ndarray, degree: int, candidates: int, alpha: float) -> np.ndarray:
    """Adjacency (rows by neighbours, -1 for none) of one shard."""
    n = len(x)
    c = min(candidates, n - 1)
    if c < 1:
        return np.full((n, 1), -1, np.int64)
    cand, sims = np.empty((n, c), np.int64), np.empty((n, c))
    for at in range(0, n, 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -2.0
        top = np.argpartition(-s, c - 1, axis=1)[:, :c]
        val = np.take_along_axis(s, top, 1)
        order = np.argsort(-val, axis=1, kind="stable")
        cand[at:at + 512], sims[at:at + 512] = np.take_along_axis(top, order, 1), np.take_along_axis(val, order, 1)
    near = robust_prune(x, cand, sims, degree, alpha)
    return with_reverse(near, n, 2 * degree)


def with_reverse(near: np.ndarray, n: int, most: int) -> np.ndarray:
    """Edges both ways, at most ``most`` for a node (own edges first)."""
    src = np.repeat(np.arange(n), near.shape[1])
    dst = near.ravel()
    ok = dst >= 0
    src, dst = src[ok], dst[ok]
    a, b = np.concatenate([src, dst]), np.concatenate([dst, src])
    own = np.concatenate([np.zeros(len(src), np.int64), np.ones(len(src), np.int64)])
    return padded(a, b, own, n, most)


def padded(a: np.ndarray, b: np.ndarray, order: np.ndarray, n: int, most: int) -> np.ndarray:
    """Edge lists a -> b as a padded table without repeats."""
    first = np.lexsort((order, b, a))
    a, b, order = a[first], b[first], order[first]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, order = a[fresh], b[fresh], order[fresh]
    again = np.lexsort((order, a))
    a, b = a[again], b[again]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    keep = place < most
    out = np.full((n, max(1, min(most, int(place.max(initial=0)) + 1))), -1, np.int64)
    out[a[keep], place[keep]] = b[keep]
    return out


def medoids(x: np.ndarray, count: int) -> np.ndarray:
    """The vectors nearest to the middle of the shard and of slices of it."""
    count = min(count, len(x))
    c = fit_centroids(x[:: max(1, len(x) // 512)], count, rounds=3)
    middle = x.mean(0, keepdims=True)
    return np.unique((np.concatenate([middle, c]) @ x.T).argmax(1))


def search(x: np.ndarray, graph: np.ndarray, least: float, beam: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) with a cosine of ``least`` or more that a search for every vector finds."""
    n, found_a, found_b = len(x), [], []
    starts = medoids(x, 16)
    for at in range(0, n, 1024):
        q = x[at:at + 1024]
        m = len(q)
        rows = np.arange(m)[:, None]
        seen = np.zeros((m, n), bool)
        seen[:, starts] = True
        ids = np.tile(starts, (m, 1))
        sims = q @ x[starts].T
        own = at + np.arange(m)  # the vector itself is a start, unless it is a medoid
        other = np.nonzero(~seen[np.arange(m), own])[0]
        seen[np.arange(m), own] = True
        first = np.full((m, 1), -2.0)
        first[other] = 1.0
        near = [(np.repeat(np.arange(m), len(starts)), ids.ravel(), sims.ravel()), (other, own[other], np.ones(len(other)))]
        ids, sims = np.concatenate([ids, own[:, None]], 1), np.concatenate([sims, first], 1)
        done = sims <= -2.0
        while True:
            open_sims = np.where(done, -2.0, sims)
            best = np.argpartition(-open_sims, min(3, ids.shape[1] - 1), axis=1)[:, :4]  # four nodes a step
            live = np.take_along_axis(open_sims, best, 1) > -2.0
            if not live.any():
                break
            np.put_along_axis(done, best, True, 1)
            nxt = graph[np.where(live, ids[rows, best], 0)]
            nxt = np.where(live[:, :, None], nxt, -1).reshape(m, -1)
            who = np.broadcast_to(rows, nxt.shape)[nxt >= 0]
            node = nxt[nxt >= 0]
            flat = np.unique(who * np.int64(n) + node)
            who, node = flat // n, flat % n
            fresh = ~seen[who, node]
            who, node = who[fresh], node[fresh]
            seen[who, node] = True
            s = np.einsum("ij,ij->i", q[who], x[node])
            near.append((who, node, s))
            place = np.arange(len(who)) - np.searchsorted(who, who)
            width = int(place.max(initial=-1)) + 1
            if width:
                add_ids, add_sims = np.zeros((m, width), np.int64), np.full((m, width), -2.0)
                add_ids[who, place], add_sims[who, place] = node, s
                ids, sims = np.concatenate([ids, add_ids], 1), np.concatenate([sims, add_sims], 1)
                done = np.concatenate([done, add_sims <= -2.0], 1)
                if ids.shape[1] > beam:
                    top = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
                    ids, sims, done = (np.take_along_axis(v, top, 1) for v in (ids, sims, done))
        who, node, s = (np.concatenate(v) for v in zip(*near))
        hit = s >= least
        found_a.append(who[hit] + at)
        found_b.append(node[hit])
        front = s >= least - slack
        who, node = who[front], node[front]
        while len(who):  # range expansion, in slices of bounded size
            new_who, new_node = [], []
            for k in range(0, len(who), 20_000):
                nxt = graph[node[k:k + 20_000]]
                w = np.broadcast_to(who[k:k + 20_000][:, None], nxt.shape)[nxt >= 0]
                flat = np.unique(w * np.int64(n) + nxt[nxt >= 0])
                w, v = flat // n, flat % n
                fresh = ~seen[w, v]
                w, v = w[fresh], v[fresh]
                seen[w, v] = True
                s = np.einsum("ij,ij->i", q[w], x[v])
                hit, front = s >= least, s >= least - slack
                found_a.append(w[hit] + at)
                found_b.append(v[hit])
                new_who.append(w[front])
                new_node.append(v[front])
            who, node = np.concatenate(new_who), np.concatenate(new_node)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    pair = np.unique(np.minimum(a, b) * np.int64(n) + np.maximum(a, b))
    a, b = pair // n, pair % n
    return a[a != b], b[a != b]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For every node the smallest one it is connected with."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def vector_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): vec_id and digest of every row (digest null where it can
    link with nothing), and one row for each different usable vector."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.col("embedding").isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
            & F.exists(v, lambda e: e != 0))
    fine = F.coalesce(fine, F.lit(False))
    each = vectors.select("vec_id", F.when(fine, v).alias("v"))
    keyed = each.select("vec_id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("h1"),
                        F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), F.col("v"))).alias("h2"))
    rows = stored(keyed.select("vec_id", "h1", "h2"), "vector-rows")
    classes = (keyed.where("v is not null").groupBy("h1", "h2")
               .agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("first_id"))
               .select(F.monotonically_increasing_id().alias("id"), "*"))
    return rows, stored(classes, "vectors")


def fit_lengths(classes: DataFrame, shard_size: int, sample: int, max_clusters: int) -> dict[int, np.ndarray]:
    """Centroids by vector length, for lengths of more than ``shard_size`` vectors
    (so at most one in ``shard_size`` vectors names one), one for each
    ``shard_size`` vectors; the overlap makes shards that much larger."""
    sizes = (classes.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > shard_size).collect())
    if not sizes:
        return {}
    count = {r["size"]: r["n"] for r in sizes}
    picked = classes.where(F.size("v").isin(list(count))).orderBy(F.xxhash64("id")).limit(sample).select("v").toArrow()
    return {length: fit_centroids(unit(matrix(rows["v"])), min(max_clusters, -(-count[length] // shard_size)))
            for length, rows in by_length(picked)}


def assign(classes: DataFrame, centroids: dict[int, np.ndarray], overlap: int) -> DataFrame:
    """Every class in its nearest clusters: shard, shards (all of its own), id, v (unit), times."""
    lists = lambda m: pa.ListArray.from_arrays(
        pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32()), pa.array(m.ravel()))

    def run(batches):
        for batch in batches:
            for length, rows in by_length(batch):
                x = unit(matrix(rows["v"]))
                near = np.zeros((len(x), 1), np.int64)
                if length in centroids:
                    c = centroids[length]
                    most = min(overlap, len(c))
                    near = np.sort(np.argpartition(-(x @ c.T), most - 1, axis=1)[:, :most], 1)
                near = near + length * LENGTH_STEP
                pick = pa.array(np.repeat(np.arange(len(x)), near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.ravel()), lists(near).take(pick), rows["id"].take(pick), lists(x).take(pick),
                     rows["times"].take(pick)], ["shard", "shards", "id", "v", "times"])
    return classes.select("id", "v", "times").mapInArrow(
        run, "shard long, shards array<long>, id long, v array<double>, times long")


def tasks(assigned: DataFrame, shard_limit: int) -> DataFrame:
    """Adds block, i and j: the task (shard, i, j) gets the blocks i and j of its
    shard; a shard within the limit is one block and one task."""
    sizes = (assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > shard_limit).collect())  # a row for a large cluster
    split = [(r.shard, -(-2 * r.n // shard_limit)) for r in sizes]
    count = F.lit(1)
    if split:
        blocks = F.create_map(*[F.lit(v) for pair in split for v in pair])
        count = F.coalesce(F.element_at(blocks, F.col("shard")), F.lit(1))
    block = F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("_blocks") - 1)
    return (assigned.withColumn("_blocks", count).withColumn("block", block).withColumn("_o", F.explode(other))
            .withColumn("i", F.least("block", "_o")).withColumn("j", F.greatest("block", "_o"))
            .drop("_blocks", "_o"))


def link_counts(classes: DataFrame, centroids: dict[int, np.ndarray], least: float, overlap: int, degree: int, candidates: int,
                alpha: float, beam: int, slack: float, shard_limit: int) -> DataFrame:
    """(id, n, root) from every task: links counted there (with repeated rows)
    and the smallest id the vector is connected with there."""
    dealt = stored(tasks(stored(assign(classes, centroids, overlap), "assigned"), shard_limit), "shards")

    def build(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        graph = build_graph(matrix(table["v"]), degree, candidates, alpha)
        lists = [ids[g[g >= 0]] for g in graph]
        return pa.table([pa.array(ids), pa.array(lists, pa.list_(pa.int64()))], ["id", "near"])

    built = dealt.groupBy("shard", "i", "j").applyInArrow(build, "id long, near array<long>")
    united = stored(built.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")

    def find(table: pa.Table) -> pa.Table:
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        ids, x, block = table["id"].to_numpy(), matrix(table["v"]), table["block"].to_numpy()
        shard, i, j = (table[c][0].as_py() for c in ("shard", "i", "j"))
        near = table["near"].combine_chunks()
        a = np.repeat(np.arange(len(ids)), np.diff(near.offsets.to_numpy()))
        b = near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(ids, b), len(ids) - 1)
        here = ids[at] == b  # edges that leave the shard are not followed
        graph = padded(a[here], at[here], np.zeros(here.sum(), np.int64), len(ids), 6 * degree)
        a, b = search(x, graph, least, beam, slack)
        own = matrix(table["shards"])
        both = own[a][:, :, None] == own[b][:, None, :]
        first = np.where(both.any(2), own[a], np.iinfo(np.int64).max).min(1)
        mine = (first == shard) & ((block[a] != block[b]) | (i == j))
        a, b = a[mine], b[mine]
        times = table["times"].to_numpy()
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, a, times[b])
        np.add.at(n, b, times[a])
        root = local_roots(len(ids), a, b)
        keep = n > 0
        return pa.table([pa.array(ids[keep]), pa.array(n[keep]), pa.array(ids[root[keep]])], ["id", "n", "root"])

    return dealt.join(united, "id").groupBy("shard", "i", "j").applyInArrow(find, "id long, n long, root long")


def audit(classes: DataFrame, counts: DataFrame, least: float, sample: int) -> tuple[int, int, float]:
    """Against brute force, for at most ``sample`` vectors: links found, links
    there, and the mean share of its links that a vector which has any finds."""
    picked = classes.orderBy(F.xxhash64("id", F.lit(3))).limit(sample).select("id", "v").toArrow()
    queries = {length: (rows["id"].to_numpy(), unit(matrix(rows["v"]))) for length, rows in by_length(picked)}

    def run(batches):
        for batch in batches:
            for length, rows in by_length(batch):
                if length in queries:
                    ids, q = queries[length]
                    hit = (unit(matrix(rows["v"])) @ q.T >= least) & (rows["id"].to_numpy()[:, None] != ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), pa.array((hit * rows["times"].to_numpy()[:, None]).sum(0))], ["id", "there"])
    there = classes.select("id", "v", "times").mapInArrow(run, "id long, there long").groupBy("id").agg(F.sum("there").alias("there"))
    found = counts.groupBy("id").agg(F.sum("n").alias("found"))
    rows = there.where("there > 0").join(found, "id", "left").select("there", F.coalesce("found", F.lit(0)).alias("found")).collect()
    shares = [r.found / r.there for r in rows]
    return sum(r.found for r in rows), sum(r.there for r in rows), sum(shares) / len(shares) if shares else 1.0


def near_duplicates(vectors: DataFrame, least: float = 0.95, shard_size: int = 1500, overlap: int = 4, degree: int = 16,
                    candidates: int = 48, alpha: float = 1.2, beam: int = 32, slack: float = 0.15,
                    shard_limit: int = 4000, sample: int = 10_000, max_clusters: int = 4096,
                    audit_sample: int = 500, min_recall: float = 0.95, log=None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.  Centroids are fitted on
    at most ``sample`` vectors, recall is measured for at most ``audit_sample``."""
    rows, classes = vector_classes(vectors)
    n = classes.count()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    centroids = fit_lengths(classes, shard_size, sample, max_clusters)
    k = max([1, *map(len, centroids.values())])
    while True:
        counts = stored(link_counts(classes, centroids, least, overlap, degree, candidates, alpha, beam, slack,
                                    shard_limit), "vector-links")
        found, there, mean = audit(classes, counts, least, audit_sample)
        if log is not None:
            log.append({"overlap": overlap, "beam": beam, "found": found, "there": there, "mean": mean})
        if (found >= min_recall * there and mean >= min_recall) or (overlap >= k and beam >= n):
            break
        overlap, beam = min(k, overlap * 2), beam * 2
    degree_of = counts.groupBy("id").agg(F.sum("n").alias("n"))
    roots = connected_components(counts.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = stored(classes.select("id", "h1", "h2", "times", "first_id")
                   .join(roots.withColumnRenamed("node", "id"), "id", "left").join(degree_of, "id", "left"), "vector-named")
    least_id = named.where("root is not null").groupBy("root").agg(F.min("first_id").alias("least"))
    final = stored(named.join(least_id, "root", "left")
                   .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                           F.coalesce("least", "first_id").alias("component_id")), "vector-final")
    out = rows.join(final, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
