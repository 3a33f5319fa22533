"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from queuelens.llm import (
    alignment, packing, perfecthash, pii, quality, quotes, ranking, simhash, tiling, tokenfile, toxicity,
    urls, warc,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Every message without quotations, linked to the message it answers."""
    return quotes.reply_order(_table(spark, sf, "conversations"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op3_tiling(spark: SparkSession, sf: str) -> DataFrame:
    """Every document and benchmark item of which it holds half or more."""
    return tiling.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find(_table(spark, sf, "documents"))


def op6_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Parts, rule and verdict of every page's URL."""
    return urls.judge(_table(spark, sf, "pages"))


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, rules and verdict for every document."""
    return quality.quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op8_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of every document, coded into files and read back."""
    return tokenfile.round_trip(_table(spark, sf, "documents"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to WARC archives and read back by the salvage reader."""
    return warc.round_trip(_table(spark, sf, "pages"))


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document packed into sequences of 2048 ids."""
    return packing.pack_documents(_table(spark, sf, "documents"))


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return alignment.alignment(_table(spark, sf, "documents"))


def op12_search(spark: SparkSession, sf: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return ranking.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op13_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The row of equal texts that stays; the lower half of the ids is the indexed history."""
    documents = _table(spark, sf, "documents")
    low, high = documents.agg(F.min("doc_id"), F.max("doc_id")).first()
    return perfecthash.remove_repeats(documents, F.col("doc_id") <= ((low or 0) + (high or 0)) // 2)


QUERIES = {
    "op1_quotes": op1_quotes,
    "op2_toxicity": op2_toxicity,
    "op3_tiling": op3_tiling,
    "op4_simhash": op4_simhash,
    "op5_pii": op5_pii,
    "op6_urls": op6_urls,
    "op7_quality": op7_quality,
    "op8_tokens": op8_tokens,
    "op9_warc": op9_warc,
    "op10_packing": op10_packing,
    "op11_alignment": op11_alignment,
    "op12_search": op12_search,
    "op13_exact": op13_exact,
}
