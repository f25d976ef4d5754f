"""From raw documents to packed training sequences, in five stages.

Each stage takes what the one before it kept. The first four return the columns of
documents: rejected documents are gone, and personal data are replaced by the name
of their kind in brackets. The last returns the token pieces with their places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import decontamination, near_dedup, packing, pii, quality
from corpusflow.llm.queries import table, tokenizer_path
from corpusflow.operators.ordering import global_index
from corpusflow.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the one with the least id, a null id last.

    Rows are told apart by their number in the order of ids, so rows with null or repeated ids are grouped like others.
    """
    numbered = global_index(docs.withColumns({"_null": F.col("doc_id").isNull(), "_hash": F.xxhash64("text")}), ["_null", "doc_id", "_hash"], "_number")
    dropped = near_dedup.near_duplicates(numbered, key="_number").filter(~F.col("kept")).select(F.col("_number").alias("_dropped"))
    return numbered.join(dropped, F.col("_number") == F.col("_dropped"), "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; `n_chars` is the length of the new text."""
    return pii.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("minhash_dedup", minhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mask_pii", mask_pii),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # stages learn models and tokenize; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
