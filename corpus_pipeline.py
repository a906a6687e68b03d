"""The corpus pipeline: documents in, packed bins of clean, distinct documents out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm.exact_dedup import exact_dedup
from strataflow.llm.jaccard_join import jaccard_components
from strataflow.llm.packing import pack_documents
from strataflow.llm.pii import replace_private
from strataflow.llm.shared import scratch, ship, stash, surrogate_key
from strataflow.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression calls toxic go."""
    return drop_toxic(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    ship(spark)
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by n-gram Jaccard similarity the row with the smallest doc_id stays. Rows without a doc_id
    stay, as do all rows that repeat the doc_id that stays."""
    ship(spark)
    found = jaccard_components(docs.select("doc_id", "text"))
    gone = stash(found.where("doc_id != component_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    ship(spark)
    return replace_private(docs, surrogate_key(spark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into bins: one row per piece."""
    ship(spark)
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("pii", private_data),
    ("best_fit_packing", packing),
]

#: Learned weights, keyed surrogates and greedy packing have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
