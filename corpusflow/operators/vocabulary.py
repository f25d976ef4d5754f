"""Vocabulary and merge list as tables, and lookups in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.sequences import SPECIAL_TOKENS, is_special
from corpusflow.operators.bpe import Tokenizer

VOCAB_SCHEMA = "token string, id int, is_special boolean"
MERGES_SCHEMA = "rank int, left string, right string, merged_id int"
BROADCAST_ENTRIES = 1_000_000


def vocab_table(spark: SparkSession, tokenizer: Tokenizer) -> DataFrame:
    rows = [(t, i, t in SPECIAL_TOKENS) for i, t in enumerate(tokenizer.tokens)]
    return spark.createDataFrame(rows, VOCAB_SCHEMA)


def merges_table(spark: SparkSession, tokenizer: Tokenizer) -> DataFrame:
    rows = [
        (rank, tokenizer.tokens[left], tokenizer.tokens[right], merged)
        for rank, (left, right, merged) in enumerate(tokenizer.merges)
    ]
    return spark.createDataFrame(rows, MERGES_SCHEMA)


def vocab_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count("*").alias("vocab_size"))


def _small(vocab: DataFrame) -> DataFrame:
    """Broadcast the vocabulary only after counting it; a larger one is joined by shuffle."""
    return F.broadcast(vocab) if vocab.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES else vocab


def token_to_id(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add `id`, NULL for an unknown token."""
    return tokens.join(_small(vocab.select("token", "id")), "token", "left")


def id_to_token(ids: DataFrame, vocab: DataFrame) -> DataFrame:
    """Add `token`, NULL for an unknown id."""
    return ids.join(_small(vocab.select("token", "id")), "id", "left")


def drop_special(ids: DataFrame) -> DataFrame:
    """Rows whose `id` is no special token at all, MASK included, as decoding drops them."""
    return ids.filter(~F.col("id").between(0, len(SPECIAL_TOKENS) - 1))


def flag_special(ids: DataFrame) -> DataFrame:
    return ids.withColumn("special", is_special(F.col("id")))
