"""Queries of the text problems 6 to 8 over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import packing, reading, tokens
from tidelake.runtime import table, write_cut


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's ids as text again."""
    back = tokens.decode_ids(p6_ids(spark, sf_dir), "doc_id", "ids")
    return back.select("doc_id", F.col("bytes").cast("string").alias("text"))


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.xxhash64("text").alias("cluster"), "text")
    return write_cut(tokens.count_tokens(d, "text"), "sizes", spark)


def p7_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_sizes(spark, sf_dir), table(spark, sf_dir, "pack_budgets"))


def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each budget the documents that have a place, and what must not be: sequences beyond the capacity, documents
    cut though they fit, copies of a text in one sequence, tokens lost or taken twice."""
    sizes, budgets = _sizes(spark, sf_dir), table(spark, sf_dir, "pack_budgets").where("capacity_tokens > 0").distinct()
    placed = packing.pack_documents(sizes, budgets).join(sizes.select("doc_id", "cluster", F.col("n_tokens").alias("size")), "doc_id").join(F.broadcast(budgets), "budget_name")
    piece = placed.where("n_tokens < capacity_tokens AND sequence_id IS NOT NULL")
    full = placed.groupBy("budget_name", "sequence_id").agg(F.sum("n_tokens").alias("n"), F.first("capacity_tokens").alias("c"))
    docs = placed.groupBy("budget_name", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"), F.first("size").alias("size"), F.first("capacity_tokens").alias("c"))
    n = docs.groupBy("budget_name").agg(F.count("*").alias("documents"), F.count_if(F.expr("pieces > 1 AND size <= c")).alias("cut"), F.count_if(F.expr("n <> size")).alias("lost"))
    over = full.where("sequence_id IS NOT NULL").groupBy("budget_name").agg(F.count_if(F.expr("n > c")).alias("over"))
    shared = piece.groupBy("budget_name", "sequence_id", "cluster").agg(F.count("*").alias("k")).groupBy("budget_name").agg(F.count_if(F.expr("k > 1")).alias("shared"))
    return n.join(over, "budget_name").join(shared, "budget_name")


def p8_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading level of every document."""
    d = reading.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))
    return d.select("doc_id", "is_english_prose", "level", F.round("level_estimate", 4).alias("level_estimate"), "n_words", "n_sentences")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = reading.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "reading_labels"))
    return d.where("is_english_prose AND level >= 4").select("doc_id")


QUERIES = {f.__name__: f for f in (p6_ids, p6_round_trip, p7_sequences, p7_checked, p8_levels, p8_found)}
SQL: dict[str, str] = {
    "p6_round_trip": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p7_checked": "SELECT DISTINCT budget_name, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0::BIGINT AS cut, 0::BIGINT AS lost, 0::BIGINT AS over, 0::BIGINT AS shared FROM pack_budgets WHERE capacity_tokens > 0",
}
