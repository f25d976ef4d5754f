"""The registered queries: each operator over its whole table, with the columns that are asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import (
    alignment,
    decontamination,
    language_id,
    license_scan,
    lm_scoring,
    merkle,
    near_dedup,
    packing,
    pii,
    quality,
    secret_scan,
    suffix_dedup,
    warc,
)
from corpusflow.llm.spans import as_text
from corpusflow.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
BYTES_TOKENIZER, PIECES_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", secret_scan.digest_of(F.col("base")).alias("base_sha256"), as_text(F.col("all")).alias("spans"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), tokenizer_path())


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("_text")


def op4_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", (remainder(7) == 2).alias("held_out"), "text")
    model = lm_scoring.train(docs.filter(~F.col("held_out")).select("text"))
    scored = lm_scoring.score(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))
    return scored.withColumn("perplexity", lm_scoring.perplexity(F.col("score"), F.col("n_tokens")))


def op5_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.scan_pii(table(spark, sf, "documents"))
    return found.select(
        "doc_id", *[f"n_{k}" for k in pii.KINDS[:4]], pii.digest_of(F.col("base")).alias("base_sha256"), as_text(F.col("all")).alias("spans"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.quality_report(table(spark, sf, "documents"))
    return report.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.repeated_runs(table(spark, sf, "documents"))
    removed = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + (r["end"] - r["low"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("runs").cast("bigint").alias("n_spans"), "kept_sha256")


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = remainder(4) == 2
    prototypes = language_id.train(docs.filter(~held_out).select("text", "lang"))
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), prototypes)


def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"), size=2, percent=80)


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf, "pages"), path, compression="gzip")
    return warc.archived_pages(spark, path)


def op11_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf, "documents"))

    def labels(*places: Column) -> Column:
        named = F.concat(*[F.transform(p, lambda x: x["label"]) for p in places])
        return F.array_join(F.array_sort(F.array_distinct(named)), ",")

    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"), labels(F.col("base")).alias("base_labels"),
        labels(F.col("base"), F.col("notices")).alias("labels"),
        F.greatest(F.coalesce(F.array_max("notices.coverage"), F.lit(0.0)), F.when(F.size("base") > 0, 1.0).otherwise(0.0)).alias("score"))


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf, "documents"), tokenizer_path(BYTES_TOKENIZER), tokenizer_path(PIECES_TOKENIZER))


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.manifest_report(table(spark, sf, "documents"), altered=remainder(2) == 0)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_packing, op3_decontamination, op4_lm_scoring, op5_pii, op6_quality, op7_suffix_dedup, op8_language_id,
    op9_near_dedup, op10_warc, op11_license_scan, op12_token_alignment, op13_merkle_manifest,
)}
