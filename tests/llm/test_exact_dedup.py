"""Exact duplicates against a plain dictionary."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tradelake.llm import exact_dedup


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def plain(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("counters", [4, 256])
def test_matches_brute_force_with_a_hot_group(spark, docs, counters):
    rows = ([(i, "hot") for i in range(400)] + [(1000 + i, f"t{i % 300}") for i in range(700)]
            + [(5000, None), (5001, ""), (5002, "x" * 300_000), (5003, "x" * 300_000), (5004, "é"), (5005, "é")])
    got = exact_dedup.exact_duplicates(docs(rows).repartition(5), counters=counters)
    assert plain(got) == brute(rows)
    one = got.groupBy("text_sha256").agg(F.sum(F.col("kept").cast("int")).alias("n"),
                                         F.max(F.when(F.col("kept"), F.col("doc_id") == F.col("keep_id"))).alias("right"))
    assert one.where("n <> 1 or not right").count() == 0


def test_the_frequent_text_is_found_and_verified(spark, docs):
    rows = docs([(i, "hot" if i % 3 else f"t{i}") for i in range(3000)]).repartition(6)
    rows = exact_dedup.digests(rows, "doc_id", None, F.monotonically_increasing_id())
    heavy = exact_dedup.winners(rows, 16).collect()
    assert [(r.n, r.keep) for r in heavy] == [(2000, 2999)]


def test_nulls_ties_and_repeated_rows(spark, docs):
    rows = [(None, "a"), (None, "a"), (7, "a"), (7, "a"), (None, "b"), (None, "b"), (3, None), (3, None)]
    got = exact_dedup.exact_duplicates(docs(rows))
    assert plain(got) == brute(rows)
    assert got.where("kept").count() == 3
    assert {(r.doc_id, r.keep_id) for r in got.where("kept").collect()} == {(7, 7), (None, None), (3, 3)}


def test_drop_copies_keeps_columns_and_one_row_a_group(spark, docs):
    frame = docs([(1, "a"), (2, "a"), (2, "a"), (3, "b")]).withColumn("UID", F.lit(1)).withColumn("n", F.lit(2))
    got = exact_dedup.drop_copies(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(2, "a"), (3, "b")]


def test_normalised_text_and_empty_table(spark, docs):
    got = exact_dedup.exact_duplicates(docs([(1, "A"), (2, "a"), (3, None)]), text=F.lower("text"))
    assert sorted((r.doc_id, r.keep_id) for r in got.collect()) == [(1, 2), (2, 2), (3, 3)]
    none = docs([])
    assert exact_dedup.exact_duplicates(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0
