import random
import re

import pytest

from pyspark.sql import functions as F

from tradelake.llm import mixing as M

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, total, cap):
    """Clamp, share the excess by weight, until nothing is above."""
    left, out = dict(sizes), {}
    while left:
        rest = total - sum(out.values())
        scale = rest / sum(weights[s] for s in left)
        above = [s for s in left if scale * weights[s] > cap * sizes[s] + 1e-9]
        if not above:
            return out | {s: scale * weights[s] for s in left}
        for s in above:
            out[s] = cap * sizes[s]
            del left[s]
    return out


def corpus(seed):
    rng = random.Random(seed)
    return [(i, "w " * rng.choice([0, 1, 7, 40, 300]), rng.choice(["a", "b", "c", "d", None, "Z", "é"][:2 + seed])) for i in range(300)]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("share", [0.4, 1.5, 2.5])
def test_targets_and_taken_words(docs, seed, share):
    rows = corpus(seed)
    got = {r.doc_id: r for r in M.taken_sizes(docs(rows), share=share).collect()}
    again = {r.doc_id: r.taken for r in M.taken_sizes(docs(list(reversed(rows))), share=share).collect()}
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    targets = filled(sizes, weights, share * sum(sizes.values()), 2)
    taken = dict.fromkeys(sizes, 0)
    for i, t, s in rows:
        r = got[i]
        assert r.size == len(WORDS.findall(t)) and r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(targets[s]) and again[i] == r.taken
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) < 1 for s in sizes)


def test_mixed_corpus_holds_the_taken_words(docs):
    rows = corpus(4) + [(900, " lead\tand  tail \n", "b")]
    d = docs(rows)
    out = M.mix(d)
    assert out.schema == d.schema
    taken = {r.doc_id: r.taken for r in M.taken_sizes(d).collect()}
    words, copies = dict.fromkeys(taken, 0), {}
    for r in out.collect():
        words[r.doc_id] += len(WORDS.findall(r.text))
        assert r.n_chars == len(r.text) and dict((i, t) for i, t, _ in rows)[r.doc_id].startswith(r.text) or r.doc_id == 900
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert words == taken and max(copies.values()) <= 2
    plan = M.taken_sizes(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edges(docs):
    d = docs([(None, "a b", None), (1, None, "x"), (2, "", "x"), (3, "c d", "y"), (3, "c d", "y")])
    rows = M.taken_sizes(d).collect()
    assert len(rows) == 5 and sum(r.taken for r in rows if r.doc_id == 3) <= 8
    assert [r.taken for r in rows if r.doc_id in (1, 2)] == [0, 0]
    assert M.taken_sizes(docs([])).count() == 0 and M.mix(docs([])).count() == 0
    assert M.mix(docs([(1, None, "x")])).select(F.col("text")).collect()[0].text is None
