import random

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tradelake.llm import simhash as S
from tradelake.llm.components import connected_components


def plain_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(n, pairs):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def test_fingerprint():
    for t in ("", None, "One", "one two", "a b c d e f", "É x Y z\tq\x0bw e", "w " * 200):
        assert S.fingerprint(t) % (1 << 64) == plain_fingerprint(t)
    long = " ".join(str(i % 97) for i in range(3000))
    assert S.fingerprint(long, step=100) == S.fingerprint(long)


@pytest.mark.parametrize("hot", [1, 3, 64])
@pytest.mark.parametrize("bits", [1, 2])
def test_components_equal_all_pairs(spark, hot, bits):
    rng = random.Random(hot)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = {0, (1 << 64) - 1}
    for _ in range(250):
        x = rng.choice(base)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = S.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits, hot=hot)
    got = {r.node: r.root for r in connected_components(links).collect()}
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= bits]
    expected = roots(len(fps), near)
    groups = {}
    for i, x in enumerate(signed):
        groups.setdefault(expected[i], set()).add(got.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(400, 400), (None, 1)], "a long, b long")
    rows = connected_components(links).collect()
    assert len(rows) == 301 and len({r.root for r in rows}) == 1
    assert connected_components(links.limit(0)).count() == 0


def test_documents(docs):
    text = " ".join(f"word{i}" for i in range(200))
    d = docs([(5, text), (3, text.upper()), (9, text.replace("word7 ", "other ")), (1, None), (2, ""), (4, "else where"),
              (4, "else where"), (None, text)])
    got = {(r.doc_id, r.fingerprint): r.component_id for r in S.near_duplicates(d).collect()}
    by = {k[0]: v for k, v in got.items()}
    assert by[5] == by[3] == by[None] == 3 and by[1] == by[2] == 1 and by[4] == 4
    assert {k[1] for k in got if k[0] in (1, 2)} == {"0" * 16}
    assert all(k[1] == f"{plain_fingerprint(text.upper()):016x}" for k in got if k[0] in (3, 5))
    kept = S.keep_one(d)
    assert kept.schema == d.schema
    assert sorted(r.doc_id for r in kept.where(F.col("doc_id") != 9).collect()) == [1, 3, 4]
    assert S.near_duplicates(docs([])).count() == 0 and S.keep_one(docs([])).count() == 0
