"""Registered queries of the training-data operators: name -> (run, sql)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import (conversation_repair, embedding_dedup, exact_dedup, line_dedup, merkle, mixing, packing, simhash,
                           token_counts, topk_search, toxicity, url_filters, warc)
from tradelake.llm.common import table
from tradelake.session import new_scratch_path

# The rules of the URL query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return topk_search.top_k(docs, queries, k=10)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"), max_edits=2, min_chars=24, every_line=True)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.taken_sizes(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2.0)
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_topk_search": op3_topk_search,
    "op4_packing": op4_packing,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_simhash": op7_simhash,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_warc": op9_warc,
    "op10_mixing": op10_mixing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_merkle": op12_merkle,
    "op13_conversation_repair": op13_conversation_repair,
}
SQL: dict[str, str] = {
    "op6_url_filters": url_filters.judge_sql(URL_RULES),
    "op9_warc": warc.round_trip_sql(),
    "op10_mixing": mixing.mixing_sql((3, 1, 2), 1.5, 2.0),
    "op11_exact_dedup": exact_dedup.duplicates_sql(),
    "op12_merkle": merkle.report_sql(),
    "op13_conversation_repair": conversation_repair.report_sql(),
}
