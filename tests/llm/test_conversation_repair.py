"""Conversation repair against a search over all edit scripts."""

import random
import re
import sys
from functools import lru_cache
from hashlib import sha256

import pytest

from tradelake.llm import conversation_repair as cr

CONV = "conv_id long, turn long, role string, text string, PIECE string, seq int, fault string"
sys.setrecursionlimit(20_000)      # the plain search goes one call deep for each edit
BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    """rows in order -> fault of each."""
    seen, out = set(), []
    for _, role, text in rows:
        if not text.strip(BLANKS):
            out.append(cr.BLANK)
        elif (role, text) in seen:
            out.append(cr.DUPLICATE)
        else:
            out.append(cr.OK if text.rstrip(BLANKS)[-1] in ".!?" else cr.CUT_OFF)
        seen.add((role, text))
    return out


def best_script(letters, found):
    """(cost, letters of the script) by trying every edit, least first."""
    @lru_cache(None)
    def rest(i, state, inserted):
        options = [(0, "")] if i == len(letters) and state in (0, 3) else []
        nxt = {0: 2, 1: 2, 3: 2, 2: 3}
        if inserted < 3:
            c, s = rest(i, nxt[state], inserted + 1)
            options.append((c + 2, "I" + s))
        if i < len(letters):
            c, s = rest(i + 1, state, 0)
            options.append((c + 3, "D" + s))
            if found[i] not in (cr.BLANK, cr.DUPLICATE):
                extra = found[i] == cr.CUT_OFF
                if letters[i] == "s" and state == 0:
                    c, s = rest(i + 1, 1, 0)
                    options.append((c + extra, "K" + s))
                to = nxt[state]
                c, s = rest(i + 1, to, 0)
                keep = letters[i] == {2: "u", 3: "a"}[to]
                options.append((c + extra + (0 if keep else 2), ("K" if keep else "R") + s))
        return min(options, default=(10 ** 9, ""))
    return rest(0, 0, 0)


def brute(rows):
    """rows of one conversation -> the report."""
    rows = [(t, r or " ", " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(r[2].encode()).hexdigest()))
    found = faults(rows)
    letters = [r[1][0] for r in rows]
    cost, audit = best_script(tuple(letters), tuple(found))
    out, i, want = [], 0, 2
    for ch in audit:
        role = {2: "user", 3: "assistant"}[want]
        if ch == "K" and letters[i] == "s" and not out:
            out.append(f"{rows[i][1]}:{rows[i][2]}")
        elif ch != "D":
            out.append(f"{rows[i][1] if ch == 'K' else role}:{'' if ch == 'I' else rows[i][2]}")
            want = 5 - want
        i += ch != "I"
    turns = [r[0] for r in rows if r[0] is not None]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count(cr.BLANK), found.count(cr.DUPLICATE),
            found.count(cr.CUT_OFF), illegal, cost, audit, sha256("\n".join(out).encode()).hexdigest())


def invented(seed, n):
    rnd = random.Random(seed)
    roles, texts = ["user", "assistant", "system", "tool", None, ""], ["Hi.", "No", " ", "", None, "What?", "End.\n", "x!", "a b"]
    return [(None if rnd.random() < .05 else rnd.randrange(n + 3), rnd.choice(roles[:3] if rnd.random() < .8 else roles),
             rnd.choice(texts) if rnd.random() < .5 else f"w{rnd.randrange(99)}.") for _ in range(n)]


def frame(spark, convs):
    return spark.createDataFrame([(c, *r, "x", 1, "y") for c, rows in convs.items() for r in rows], CONV)


def reports(df):
    return {r.conv_id: tuple(r)[1:] for r in cr.report(cr.repair(df)).collect()}


def test_random_conversations_match_all_scripts(spark):
    convs = {i: invented(i, 1 + i % 9) for i in range(150)} | {None: invented(999, 7)}
    convs |= {200: [(0, "system", "Only.")], 201: [(0, "user", " ")], 202: [(None, None, None)] * 3,
              203: [(0, "user", "x" * 200_000), (1, "assistant", "y" * 200_000 + ".")]}
    assert reports(frame(spark, convs)) == {c: brute(rows) for c, rows in convs.items()}


def test_a_conversation_cut_into_pieces_gives_the_same_script(spark):
    convs = {1: invented(5, 400), 2: invented(6, 3), 3: [(i, "user", f"q{i}.") for i in range(200)]}
    df = frame(spark, convs)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edits = cr.repair(df)
        pieces = {r.conv_id: r.n for r in edits.groupBy("conv_id").agg({"piece": "max"}).toDF("conv_id", "n").collect()}
        assert edits.where("conv_id = 1").select("piece").distinct().count() > 2, pieces
        got = {r.conv_id: tuple(r)[1:] for r in cr.report(edits).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == {c: brute(rows) for c, rows in convs.items()}


@pytest.mark.parametrize("seed", range(40))
def test_cut_states_and_ties_agree_with_one_search(seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("suat"), rnd.random() < .2, rnd.random() < .3) for _ in range(30)]
    whole = cr.Survivors()
    for r in rows:
        whole.step(*r)
    whole.finish()
    want = "".join(n.edit for n in whole.take())
    at = sorted(rnd.sample(range(31), 3))
    parts = [rows[a:b] for a, b in zip([0, *at], [*at, 30])]
    states = cr.cuts([cr.transfer(p, i == 3) for i, p in enumerate(parts)])
    got = ""
    for part, (entry, to) in zip(parts, states):
        one = cr.Survivors(entry)
        for r in part:
            one.step(*r)
        one.finish() if to == cr.END else one.settle(to)
        got += "".join(n.edit for n in one.take())
    assert got == want


def test_edits_are_emitted_early_and_memory_stays_bounded():
    search, held, out = cr.Survivors(), 0, 0
    for i in range(20_000):
        search.step("ua"[i % 2], False, False)
        out += len(search.take())
        held = max(held, search.unresolved())
    assert held < 60 and out > 19_900
    # Never settled: no script is final, and no dead branch stays either.
    search = cr.Survivors()
    for i in range(2_000):
        search.step("x", False, True)
        search.take()
    assert search.unresolved() < 5 * 2_000


def test_query_keeps_every_conversation_and_the_repaired_rows_are_legal(spark):
    rows = [(i % 50 if i % 7 else None, i // 50, ["user", "assistant", "system", None][i % 4], None if i % 13 == 0 else f"t{i}.", "x", 1, "y")
            for i in range(600)]
    df = spark.createDataFrame(rows, CONV)
    got = cr.damage_report(df).collect()
    assert len(got) == df.select("conv_id").distinct().count()
    lost = spark.createDataFrame([(0, t, "user", "a.", "x", 1, "y") for t in range(400)], CONV)
    kinds = lost.selectExpr("conv_id", "turn", "crc32(concat(conv_id, ':', turn)) % 20 k").where("k = 0").limit(1)
    gone = cr.damage_report(lost.join(kinds.select("turn"), "turn", "left_semi").select(*lost.columns)).collect()
    assert [tuple(r) for r in gone] == [(0, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
    assert cr.damage_report(df.limit(0)).count() == 0
    lines = {}
    for r in cr.repaired(cr.repair(df)).collect():
        lines.setdefault(r.conv_id, []).append(((r.piece, r.seq), r.role[0]))
    for conv in lines.values():
        assert re.fullmatch("s?(ua)+", "".join(x for _, x in sorted(conv)))
