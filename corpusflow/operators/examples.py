"""Training examples from encoded texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.logits import IGNORE_INDEX
from corpusflow.functions.sequences import MASK, PAD, count_of, ids_text, mask_tokens, masked_labels, next_token_labels, pad_ids
from corpusflow.operators.bpe import Tokenizer
from corpusflow.operators.encode import as_encoding, batch_ids, encode_batches, others


def prepare_inputs(
    df: DataFrame,
    tokenizer: Tokenizer,
    batch: str = "batch_id",
    max_length: int | None = None,
    padding: bool = True,
    truncation: bool = True,
    text: bool = False,
) -> DataFrame:
    """Encoded batches, padded and truncated by default; with `text` the ids as space-separated text."""
    return encode_batches(df, tokenizer, batch, True, truncation, max_length, padding, text)


def with_causal_labels(inputs: DataFrame, label_pad_id: int = PAD) -> DataFrame:
    """Labels are the next tokens; the last one is padding, which is scored unless replaced."""
    return inputs.withColumn("labels", next_token_labels(F.col("input_ids"), label_pad_id))


def with_masked_labels(
    inputs: DataFrame,
    row_key: Column,
    vocab_size: int,
    mask_prob: float = 0.15,
    seed: int = 0,
    only_changed: bool = False,
) -> DataFrame:
    """Mask random tokens; the labels are a copy of all original ids unless `only_changed`."""
    masked = inputs.withColumn("_masked", mask_tokens(F.col("input_ids"), row_key, vocab_size, mask_prob, seed))
    labels = masked_labels(F.col("input_ids"), F.col("_masked"), only_changed)
    return masked.withColumn("labels", labels).withColumn("input_ids", F.col("_masked")).drop("_masked")


def causal_lm_inputs(df: DataFrame, tokenizer: Tokenizer, label_pad_id: int = PAD, batch: str = "batch_id", max_length: int | None = None,
                     padding: bool = True, truncation: bool = True, text: bool = False) -> DataFrame:
    """Inputs and their next-token labels; the ids are shifted before they are padded."""
    encoded, length, pad = batch_ids(df, tokenizer, batch, True, truncation, max_length, padding)
    ids = F.col("ids")
    shifted = F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))
    before_last = (F.lit(length) if isinstance(length, int) else length) - 1 if padding else None
    if text:
        labels = F.ltrim(F.concat(ids_text(shifted, before_last, pad), F.lit(f" {label_pad_id}")))
    else:
        labels = F.concat(pad_ids(shifted, before_last, pad), F.array(F.lit(label_pad_id)))
    return encoded.select(*others(df), *as_encoding(ids, length, padding, pad, text), labels.alias("labels"))


def masked_lm_inputs(df: DataFrame, tokenizer: Tokenizer, row_key: Column, mask_prob: float = 0.15, seed: int = 0,
                     only_changed: bool = False, batch: str = "batch_id", max_length: int | None = None, padding: bool = True,
                     truncation: bool = True, text: bool = False) -> DataFrame:
    """Masked inputs and their labels. Padding is never masked, so the ids are masked before they are padded."""

    def masked(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_masked", mask_tokens(F.col("ids"), row_key, tokenizer.vocab_size, mask_prob, seed))

    encoded, length, pad = batch_ids(df, tokenizer, batch, True, truncation, max_length, padding, masked)
    labels = masked_labels(F.col("ids"), F.col("_masked"), only_changed)
    fill = IGNORE_INDEX if only_changed else pad
    wanted = length if padding else None
    labels = ids_text(labels, wanted, fill) if text else pad_ids(labels, wanted, fill)
    return encoded.select(*others(df), *as_encoding(F.col("_masked"), length, padding, pad, text), labels.alias("labels"))


def masked_token_count(inputs: DataFrame, ids: str = "input_ids") -> DataFrame:
    return inputs.agg(F.coalesce(F.sum(count_of(F.col(ids), MASK)), F.lit(0)).alias("masked_tokens"))


def example_audit(inputs: DataFrame, length: Column | int) -> DataFrame:
    """One row of counts: rows, rows with a mask token, and rows that keep each length rule."""
    wanted = F.lit(length) if isinstance(length, int) else length
    ids = F.size("input_ids")
    return inputs.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.array_contains("input_ids", MASK)).alias("with_mask"),
        F.count_if((ids == wanted) & (F.size("attention_mask") == wanted)).alias("of_length"),
        F.count_if(F.size("labels") == ids).alias("labels_fit"),
    )


def alignment_check(examples: DataFrame) -> DataFrame:
    """Whether every example's inputs, from the second on, equal its labels but the last."""
    n = F.size("input_ids")
    inputs = F.slice("input_ids", F.lit(2), F.greatest(n - 1, F.lit(0)))
    labels = F.slice("labels", F.lit(1), F.greatest(n - 1, F.lit(0)))
    return examples.agg(F.coalesce(F.bool_and(inputs == labels), F.lit(True)).alias("aligned"))
