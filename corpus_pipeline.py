"""The corpus pipeline: quality, exact copies, near copies, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept,
and returns the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm import exact_dedup, mixing, packing, quality_lm, simhash
from cellweave.llm.common import materialize, reachable


@reachable
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the perplexity limit of their language; those labelled as good are the trusted text."""
    return quality_lm.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id", "text", "lang", "quality")


@reachable
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.deduplicate(docs, "doc_id", "text")


@reachable
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id."""
    return simhash.deduplicate(docs, "doc_id", "text")


@reachable
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it: as many rows."""
    return mixing.apply_mix(docs, "doc_id", "text", "source")


@reachable
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences of 2,048 ids."""
    return packing.best_fit_pack(docs, "doc_id", "text")


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]
#: A language model and token ids can't be said in SQL; tests/llm/test_pipeline.py compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
