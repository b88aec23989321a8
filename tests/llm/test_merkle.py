"""Merkle manifest against trees built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tradelake.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, LEAF string, path int, rank int, tree string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def path_of(levels, i, arity):
    out = []
    for level in levels[:-1]:
        start = i // arity * arity
        out.append((level[start:i], level[i + 1:start + arity]))
        i //= arity
    return out


def leaf_of(r, text):
    write = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*[write(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def brute(rows, arity=8):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    trees = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees[g] = levels_of([leaf_of(r, r["text"]) for r in members], arity)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = levels_of([trees[g][-1][0] for g in order], arity)
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            path = path_of(trees[g], i, arity) + path_of(top, k, arity)
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = text.encode().lower().decode()
            node = leaf_of(r, text)
            for before, after in path:
                node = H(*before, node, *after)
            out.append((r["doc_id"], leaf_of(r, r["text"]), trees[g][-1][0], top[-1][0],
                        H(*[x for a, b in path for x in a + b]), node, node == top[-1][0]))
    return sorted(out, key=str)


def made(rows):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513, 600])
def test_every_size_matches_plain_trees(spark, n):
    rows = [(i * 7 % (n + 1), f"Text {i}", "en", "s", i) for i in range(n)]
    frame = spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], DOCS).repartition(3)
    assert sorted(map(tuple, merkle.tamper_report(frame).collect()), key=str) == brute(made(rows))


def test_many_groups_nulls_ties_and_long_texts(spark):
    rows = [(i, None if i % 11 == 0 else f"Äß {i}", None if i % 5 == 0 else f"l{i % 23}", None, None) for i in range(300)]
    rows += [(5, "Same", "l1", "s", 4)] * 3 + [(None, "A", "l1", "s", 1), (None, None, None, None, None), (900, "", "", "", 0),
                                               (901, "Long " * 60_000, "é", "s", 5)]
    frame = spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], DOCS).repartition(4)
    assert sorted(map(tuple, merkle.tamper_report(frame).collect()), key=str) == brute(made(rows))


def test_small_arity_needs_many_rounds_and_the_log_is_gapless_postorder(spark):
    n = 100
    rows = [(i, f"T{i}", "en" if i < 90 else "fr", "s", i) for i in range(n)]
    frame = spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], DOCS)
    done = merkle.manifest(frame, arity=2)
    assert len(done.rows.rounds) == 3       # 90 leaves, 8 in a run
    out = merkle.prove(done)
    want = {r[0]: r[1:5] for r in brute(made(rows), 2)}
    got = out.select("id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")),
                     merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).collect()
    assert {r[0]: tuple(r[1:5]) for r in got} == want and all(r[5] for r in got)
    for tree, count in (("2:en", 90), ("2:fr", 10)):
        nodes = merkle.log_nodes(done.rows).where(F.col("tree") == tree).orderBy("position").collect()
        levels = levels_of([leaf_of(r, r["text"]) for r in made(rows) if ("2:" + r["lang"]) == tree], 2)
        order = []

        def visit(level, i):
            if level:
                for j in range(2 * i, min(2 * i + 2, len(levels[level - 1]))):
                    visit(level - 1, j)
            order.append((level, levels[level][i]))
        visit(len(levels) - 1, 0)
        assert [r.position for r in nodes] == list(range(len(order))) and count == len(levels[0])
        assert [(r.level, r.digest) for r in nodes] == order


def test_closed_form_positions_equal_the_append_order():
    for arity in (2, 3, 8):
        for leaves in (1, 2, 3, 7, 8, 9, 26, 27, 28, 64, 65, 200):
            top = merkle.height(leaves, arity)
            log = merkle.append_log([f"n{i}" for i in range(leaves)], top, arity)
            levels = levels_of([f"n{i}" for i in range(leaves)], arity)
            for level, nodes in enumerate(levels):
                for i, node in enumerate(nodes):
                    assert log[merkle.position(level, i, leaves, top, arity)] == node
            assert len(log) == sum(map(len, levels))


def test_any_change_of_a_leaf_fails_and_an_empty_table_has_no_rows(spark):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(20)]
    frame = spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], DOCS)
    out = merkle.prove(merkle.manifest(frame))
    bad = out.where(merkle.folded(F.sha2(F.concat("leaf", F.lit("!")), 256), F.col("path")) == F.col("root"))
    assert bad.count() == 0
    assert merkle.tamper_report(frame.limit(0)).count() == 0
