import random

from tradelake.llm import toxicity as T


def corpus(docs, spark, n=400):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "field", "window", "garden"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(10, 40))]
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), "zorgblat")
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_folding():
    assert T.fold("1D10T") == " idiot "
    assert T.fold("іdіоt!!") == " idiot "
    assert T.fold("SCUM***") == " scum "
    assert T.fold("l@sеr") == " laser "
    assert T.fold("mo​ron") == " moron "
    assert T.fold("ｉｄｉｏｔ") == " idiot "
    assert T.fold(None).strip() == "" and T.fold("").strip() == ""


def test_learned_scores_on_held_out_rows(spark, docs):
    d, labels = corpus(docs, spark)
    model = T.fit(d, labels)
    assert " zorgblat " in model.weights
    got = {r.doc_id: r for r in T.score(d, model).collect()}
    held = [r for r in got.values() if r.held_out]
    assert len(got) == 400 and held
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in held)
    assert all((r.predicted == 1) == (r.score >= 0.3) for r in got.values())


def test_labels_of_the_held_out_fold_are_never_read(spark, docs):
    d, labels = corpus(docs, spark)
    kept = labels.where(~T.held_out(labels.doc_id))
    assert T.fit(d, labels).weights == T.fit(d, kept).weights


def test_obfuscation_and_exceptions(docs):
    m = T.ToxicityModel({" idiot ": 5.0, " clown ": 5.0})
    got = {r.doc_id: r.score for r in T.score(docs([
        (1, "you 1d10t"), (2, "a clown fish swims"), (3, "a plain line"), (4, "such a clown, really"),
        (5, "idiotic")]), m).collect()}
    assert got[1] > got[3] and got[4] > got[3] and got[2] == got[3] == got[5]


def test_edges(spark, docs):
    m = T.ToxicityModel({" scum ": 6.0}, coef=(-3.0, 1.0, 1.0))
    d = docs([(None, "scum"), (1, None), (2, ""), (3, "scum"), (3, "scum"), (4, "word " * 50_000)])
    rows = T.score(d, m).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    kept = T.filter_clean(d, m)
    assert kept.schema == d.schema and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert T.score(docs([]), m).count() == 0 and T.filter_clean(docs([]), m).count() == 0


def test_without_labels_the_seed_terms_serve(spark, docs):
    m = T.fit(docs([(1, "a")]), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert " idiot " in m.weights
