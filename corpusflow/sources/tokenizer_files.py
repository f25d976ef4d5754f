"""Saving and loading a trained tokenizer."""

from __future__ import annotations

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.sequences import CLS, MASK, PAD, SEP, SPECIAL_TOKENS
from corpusflow.operators.bpe import Tokenizer
from corpusflow.operators.vocabulary import merges_table, vocab_table


def save_tokenizer_tables(spark: SparkSession, tokenizer: Tokenizer, path: str) -> None:
    """Tables `vocab` and `merges`, and a one-row `config`."""
    vocab_table(spark, tokenizer).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    merges_table(spark, tokenizer).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
    names = {"cls_token": CLS, "sep_token": SEP, "mask_token": MASK, "pad_token": PAD}
    config = spark.range(1).select(
        F.lit(tokenizer.vocab_size).alias("vocab_size"),
        F.struct(*[F.lit(SPECIAL_TOKENS[i]).alias(n) for n, i in names.items()]).alias("special_tokens"),
    )
    config.coalesce(1).write.mode("overwrite").json(f"{path}/config")


def _by_id(vocab: list[Row]) -> tuple[str, ...]:
    """Tokens ordered by id; ids that leave gaps or repeat, and tokens that repeat, raise."""
    if [r["id"] for r in vocab] != list(range(len(vocab))):
        raise ValueError("token ids must be 0, 1, 2, ... without gaps or repeats")
    tokens = tuple(r["token"] for r in vocab)
    if len(set(tokens)) < len(tokens):
        raise ValueError("a token has several ids")
    return tokens


def load_tokenizer_tables(spark: SparkSession, path: str) -> Tokenizer:
    vocab = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    ids = {r["token"]: r["id"] for r in vocab}
    return Tokenizer(
        _by_id(vocab),
        tuple((ids[r["left"]], ids[r["right"]], r["merged_id"]) for r in merges),
    )


def import_tokenizer_files(spark: SparkSession, folder: str) -> Tokenizer:
    """From `vocab.json` (token to id) and `merges.txt` (a pair per line, a `#version` line first)."""
    vocab = (
        spark.read.text(f"{folder}/vocab.json", wholetext=True)
        .select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "id"))
        .orderBy("id")
        .collect()
    )
    lines = spark.read.text(f"{folder}/merges.txt", wholetext=True).first()["value"].split("\n")
    ids = {r["token"]: r["id"] for r in vocab}
    pairs = [line.split(" ") for line in lines if line and not line.startswith("#version")]
    return Tokenizer(_by_id(vocab), tuple((ids[a], ids[b], ids[a + b]) for a, b in pairs))
