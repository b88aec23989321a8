import numpy as np
import pytest

from tradelake.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=0, n=600, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[100:180] = x[0] + rng.normal(size=(80, dim)) * 0.02  # a large group
    x[200:240] = x[200:240] * 0 + x[300:340] + rng.normal(size=(40, dim)) * 0.03  # pairs
    x[400:405] = x[399]  # equal ones
    return x.astype(np.float32)


def truth(x, least=0.95):
    u = E.unit(x)
    link = u @ u.T >= least
    np.fill_diagonal(link, False)
    a, b = np.nonzero(link)
    return link.sum(1), E.local_roots(len(x), a, b)


@pytest.mark.parametrize("limit", [10_000, 60])
def test_links_and_components(spark, limit):
    x = vectors()
    counts, roots = truth(x)
    frame = spark.createDataFrame([(i, [float(v) for v in row], i % 3) for i, row in enumerate(x)], SCHEMA)
    log = []
    got = {r.vec_id: r for r in E.near_duplicates(frame, shard_size=100, shard_limit=limit, log=log).collect()}
    n = np.array([got[i].n_links for i in range(len(x))])
    assert len(got) == len(x) and (n <= counts).all() and n.sum() >= 0.97 * counts.sum()
    assert all(got[i].component_id <= i and got[i].kept == (got[i].component_id == i) for i in got)
    assert np.mean([got[i].component_id == roots[i] for i in got]) > 0.99
    assert log[-1]["found"] >= 0.95 * log[-1]["there"]


def test_recall_is_audited_and_raised(spark):
    x = vectors(1)
    frame = spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA)
    log = []
    rows = E.near_duplicates(frame, shard_size=20, overlap=1, beam=2, degree=2, candidates=3, slack=0.0, min_recall=0.99, log=log).collect()
    assert len(rows) == len(x) and log[-1]["found"] >= 0.99 * log[-1]["there"]


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 0), (2, [2.0, 4.0, 6.0], 0), (3, None, 0), (4, [0.0] * 3, 0), (5, [1.0, None, 3.0], 0), (6, [], 0),
            (7, [1.0, float("nan"), 3.0], 0), (8, [1.0, float("inf"), 3.0], 0), (9, [1.0, 2.0], 0), (2, one, 0), (None, one, 0)]
    got = E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 11
    assert {r.component_id for r in got if r.vec_id in (1, 2, None)} == {1}
    assert all(r.n_links == 3 for r in got if r.vec_id in (1, 2, None))
    assert all(r.n_links == 0 and r.kept and r.component_id == r.vec_id for r in got if r.vec_id in range(3, 10))
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_length_is_compared(spark):
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for dim, n in ((24, 300), (16, 150), (3, 2)):
        x = vectors(dim, 600, dim)[:n] if n > 2 else np.array([[1.0, 2.0, 3.0], [1.0, 2.0, 3.1]], np.float32)
        rows += [(at + i, x[i], dim) for i in range(n)]
        at += n
    rng.shuffle(order := np.arange(len(rows)))
    frame = spark.createDataFrame([(rows[i][0], [float(v) for v in rows[i][1]], 0) for i in order], SCHEMA)
    got = {r.vec_id: r for r in E.near_duplicates(frame, shard_size=60).collect()}
    for dim in (24, 16, 3):
        ids = [r[0] for r in rows if r[2] == dim]
        counts, roots = truth(np.array([rows[i][1] for i in ids]))
        n = np.array([got[i].n_links for i in ids])
        assert counts.sum() > 0 and (n <= counts).all() and n.sum() >= 0.95 * counts.sum()
        assert np.mean([got[i].component_id == ids[0] + r for i, r in zip(ids, roots)]) > 0.99


def test_planted_pairs_over_many_clusters(spark):
    rng = np.random.default_rng(9)
    x = E.unit(rng.normal(size=(3000, 64)))
    for i in range(300):  # pairs just above the threshold, far from everything else
        side = rng.normal(size=64)
        side -= side @ x[i] * x[i]
        x[1500 + i] = 0.953 * x[i] + np.sqrt(1 - 0.953 ** 2) * side / np.linalg.norm(side)
    x[2000:2400] = x[1999] + rng.normal(size=(400, 64)) * 0.01  # a large group
    x = x.astype(np.float32)
    counts, roots = truth(x)
    frame = spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA)
    log = []
    got = {r.vec_id: r for r in E.near_duplicates(frame, shard_size=250, log=log).collect()}
    planted = [i for i in range(300) if counts[i] == 1]
    assert len(planted) > 250 and sum(got[i].n_links for i in planted) >= 0.9 * len(planted)
    assert all(got[i].n_links <= counts[i] for i in got)
    assert sum(got[i].n_links for i in range(1999, 2400)) >= 0.95 * counts[1999:2400].sum()  # what the audit asks for
    assert np.mean([got[i].component_id == roots[i] for i in range(1999, 2400)]) > 0.99
    assert log[-1]["mean"] >= 0.95


def test_robust_prune_drops_covered_neighbours():
    x = E.unit(np.array([[1, 0.0], [0.99, 0.1], [0.98, 0.14], [0.0, 1.0]]))
    cand = np.array([[1, 2, 3], [2, 0, 3], [1, 0, 3], [2, 1, 0]])
    sims = np.take_along_axis(x @ x.T, cand, 1)
    near = E.robust_prune(x, cand, sims, 3, 1.2)
    assert near[0].tolist() == [1, 3, -1]  # 2 is nearer to 1 than to 0
    graph = E.build_graph(x, 2, 3, 1.2)
    assert all((row >= 0).any() for row in graph)
