"""Corpus pipeline: toxicity, line dedup, near-duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  ``run`` writes each stage's result to the shared folder and reads it
again, as a scheduled job would, so a lost executor costs one stage at most.
The two stages that store many intermediates remove them before they return.

Defined results, for every stage: a null text counts as an empty one and stays
null unless a line is taken out of it; rows of one id, or of no id, are rows of
their own; an empty table gives an empty one; columns beyond those of documents
stay as they are up to mixing, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradelake.llm import line_dedup, mixing, packing, simhash, toxicity
from tradelake.llm.common import settled, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score under 0.3; the model is learned from ``docs`` and the labels.
    Null and empty texts and those without a lexicon entry are clean and stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filter_clean(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that repeat an earlier line; all rows stay.  Of equal rows
    one keeps its lines."""
    return settled(lambda: line_dedup.drop_repeated_lines(docs, max_edits=2, min_chars=24), "line-dedup")


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, that of the smallest id.
    Texts without a word have fingerprint zero and form one group."""
    return settled(lambda: simhash.keep_one(docs, shingle=3, max_bits=2), "near-duplicates")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target wants it."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, max_epochs=2.0)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their training sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("near_duplicates", near_dup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs


ORACLE_SQL = None
