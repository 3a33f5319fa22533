"""The corpus pipeline: five stages over ``documents``, each calling one operator.

Every stage works on all that the one before kept, and takes and returns rows with the
columns of ``documents``; only the last returns the packed pieces. Stages that drop documents
number the rows first and drop by that number, so rows without an id, or that repeat one,
are judged like any other. Null texts are empty texts to every stage. An empty table stays one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from queuelens.llm import packing, pii, simhash, tiling, toxicity
from queuelens.llm.frames import kept, small_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written with a number for every row."""
    return kept(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifiers do not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.scored(docs, toxicity.learn(docs, labels), score="__toxicity")
    return scored.where("__toxicity < 0.5").select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies; null ids come last.

    Of several such rows the first stays. Groups are told by the number of their first row.
    """
    rows = _numbered(docs)
    found = kept(simhash.near_duplicates(rows, key=ROW), "near-copies").select(
        F.col("doc_id").alias(ROW), "component_id")
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = kept(found.join(several, "component_id").join(rows.select(ROW, "doc_id"), ROW), "copies")
    first = members.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW].alias(ROW))
    dropped = members.select(ROW).join(first.select(ROW), ROW, "left_anti")
    return rows.join(dropped, ROW, "left_anti").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items, rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet"), _numbered(docs)
    found = kept(tiling.contaminated(rows, items, key=ROW), "contaminated")
    return rows.join(found.select(F.col("doc_id").alias(ROW)).distinct(), ROW, "left_anti").select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and ``n_chars`` counted anew."""
    return pii.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents, with sequence and offset."""
    return packing.pack_documents(docs)


def _in_small_batches(stage: Stage) -> Stage:
    """``stage`` with small batches for its Python workers, which outlive a stage beside the heap."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _in_small_batches(clean_of_toxicity)),
    ("near-duplicates", _in_small_batches(one_of_each_group)),
    ("decontamination", _in_small_batches(decontaminated)),
    ("personal data", _in_small_batches(without_personal_data)),
    ("packing", _in_small_batches(packed)),
]

# Fingerprints, a trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; every stage is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"stage-{place}")
    return docs
