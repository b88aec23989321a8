import random

import pytest

from tradelake.llm import line_dedup as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, edits):
    cells = list(text)
    for _ in range(edits):
        i = rng.randrange(len(cells) + 1)
        kind = rng.randrange(3)
        if kind == 0 or i == len(cells):
            cells.insert(i, rng.choice("abcé😀"))
        elif kind == 1:
            cells[i] = rng.choice("abcé😀")
        else:
            del cells[i]
    return "".join(cells)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(spark, edits):
    rng, pairs = random.Random(edits), set()
    for _ in range(250):
        a = "".join(rng.choice("abcé😀") for _ in range(rng.choice([0, 1, 2, 3, 30, 64, 65, 130, 200])))
        pairs.add((a, changed(rng, a, rng.randrange(edits + 3))))
    frame = spark.createDataFrame(sorted(pairs), "a string, b string")
    got = {(r.a, r.b): r.edits for r in L.verified(frame, edits).collect()}
    assert got == {p: d for p in pairs if (d := distance(*p)) <= edits}


@pytest.mark.parametrize("edits,hot,crowded", [(1, 100, 100), (2, 100, 100), (2, 2, 2000), (2, 2, 5), (3, 3, 8), (0, 9, 9)])
def test_links_equal_all_pairs(spark, edits, hot, crowded):
    rng = random.Random(7)
    base = ["".join(rng.choice("abc ") for _ in range(rng.randrange(24, 40))) for _ in range(30)]
    lines = sorted({changed(rng, rng.choice(base), rng.randrange(5)) for _ in range(260)})
    frame = spark.createDataFrame([(i, x, len(x)) for i, x in enumerate(lines)], "id long, line string, len int")
    expected = {(i, j): d for i in range(len(lines)) for j in range(i + 1, len(lines))
                if abs(len(lines[i]) - len(lines[j])) <= edits and (d := distance(lines[i], lines[j])) <= edits}
    got = {(r.a, r.b): r.edits for r in L.line_links(frame, edits, hot, crowded).collect()}
    assert got == (expected if edits else {})


LINE = "a line that many documents share, in this form"


def test_documents(docs):
    d = docs([(4, f"own words of the fourth text\n{LINE}"), (2, f"{LINE}\nshort\nown words of the second text"),
              (3, f"short\n{LINE}!!\n{LINE}"), (5, None), (6, ""), (None, LINE), (7, LINE + "and quite some more words")])
    rows = {(r.doc_id, r.line_no): r for r in L.line_classes(d, 2, 24).collect()}
    assert len(rows) == 8
    assert [k for k, r in sorted(rows.items(), key=str) if not r.kept] == [(3, 1), (3, 2), (4, 1), (None, 0)]
    assert all((r.class_doc, r.class_line) == (2, 0) for r in rows.values() if not r.kept)
    assert rows[3, 1].n_links == 1 and rows[2, 0].n_links == 1 and rows[7, 0].n_links == 0
    out = L.drop_repeated_lines(d, 2, 24)
    assert out.schema == d.schema
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 7 and got[3].text == "short" and got[3].n_chars == 5 and got[5].text is None and got[6].text == ""
    assert got[2].text == f"{LINE}\nshort\nown words of the second text" and got[None].text == ""


def test_repeated_rows_and_empty_input(docs):
    d = docs([(1, LINE), (1, LINE), (2, f"{LINE}\n{LINE}")])
    assert L.line_classes(d).where("kept").count() in (1, 2)  # equal rows cannot be told apart without a row key
    assert sorted(len(r.text) for r in L.drop_repeated_lines(d).collect()) == [0, 0, len(LINE)]
    assert L.line_classes(docs([])).count() == 0 and L.drop_repeated_lines(docs([])).count() == 0


def test_only_sql_on_the_main_path(docs):
    plan = L.line_classes(docs([(1, LINE)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("edits,chars", [(2, 24), (3, 18), (1, 10), (0, 24)])
def test_every_line_against_all_pairs(spark, docs, edits, chars):
    rng = random.Random(11)
    base = ["".join(rng.choice("ab é😀") for _ in range(rng.randrange(1, 32))) + "x" for _ in range(40)]
    lines = [changed(rng, rng.choice(base), rng.randrange(4)).rstrip() for _ in range(300)]
    d = docs([(i, "\n".join(lines[i * 10:i * 10 + 10] + ["", "  \t"])) for i in range(30)])
    places = [(i // 10, i % 10) for i, x in enumerate(lines) if x]
    text = {(i // 10, i % 10): x for i, x in enumerate(lines) if x}

    def linked(a, b):
        most = min(edits, min(len(a), len(b)) * edits // chars)
        return a != b and abs(len(a) - len(b)) <= most and distance(a, b) <= most
    near = {a: [b for b in set(text.values()) if linked(a, b)] for a in set(text.values())}
    root = {}
    for p in places:  # in order, so the first place of a class names it
        todo = [text[p]]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = p
                todo += near[x]
    rows = {(r.doc_id, r.line_no): r for r in L.line_classes(d, edits, chars, every_line=True).collect()}
    assert set(rows) == set(places)
    for p, r in rows.items():
        assert (r.class_doc, r.class_line) == root[text[p]] and r.kept == (root[text[p]] == p)
        assert r.n_links == len(near[text[p]])


def test_query_covers_short_lines(spark):
    from tradelake.llm.queries import op5_line_dedup
    sf = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()
    lines = [x.rstrip(" \t\n\v\f\r") for r in texts if r.text for x in r.text.split("\n")]
    rows = op5_line_dedup(spark, sf)
    assert rows.count() == sum(x != "" for x in lines) > sum(len(x) >= 24 for x in lines)


def test_probes_are_made_once_and_indexes_removed(spark, docs, monkeypatch):
    """Busy keys come out of the join of the calm ones; what the links needed is gone after them."""
    kept, names = L.stored, []
    monkeypatch.setattr(L, "stored", lambda df, name: (names.append(name), kept(df, name))[1])
    import glob
    from tradelake.session import checkpoint_root
    root = checkpoint_root(spark).removeprefix("file://").removeprefix("file:")
    before = set(glob.glob(f"{root}/segments-*") + glob.glob(f"{root}/line-hits-*"))
    line = "a line that is common to all of these texts {}"
    texts = docs([(i, line.format(chr(97 + i) * 2)) for i in range(20)] + [(99, "x" * 30), (98, "x" * 30 + "y")])
    rows = L.line_classes(texts, 2, 24, hot=4).collect()
    assert "line-hits" in names and "hot-probes" not in names
    assert set(glob.glob(f"{root}/segments-*") + glob.glob(f"{root}/line-hits-*")) == before
    assert {r.doc_id: r.n_links for r in rows} == {**{i: 19 for i in range(20)}, 98: 1, 99: 1}
