"""Scores over tables of logits `(…, logits ARRAY<FLOAT>, label INT)` and of generated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.hashing import digest, uniform_from
from corpusflow.functions.logits import (
    IGNORE_INDEX,
    argmax,
    candidates,
    draw,
    label_in_top,
    negative_log_likelihood,
    top_k_filter,
    top_n_indices,
    valid_label,
)


def with_predictions(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", argmax(F.col("logits")))


def with_top_indices(scored: DataFrame, n: int = 5) -> DataFrame:
    return scored.withColumn("top_indices", top_n_indices(F.col("logits"), n))


def with_top_k(scored: DataFrame, k: int) -> DataFrame:
    return scored.withColumn("logits", top_k_filter(F.col("logits"), k))


def accuracy(scored: DataFrame, ignore_index: int = IGNORE_INDEX) -> DataFrame:
    """Correct share of the valid labels; NULL when there are none."""
    valid = scored.filter(valid_label(F.col("label"), ignore_index))
    return valid.agg(F.try_divide(F.count_if(argmax(F.col("logits")) == F.col("label")), F.count("*")).alias("accuracy"))


def token_level_metrics(scored: DataFrame, n: int = 5, ignore_index: int = IGNORE_INDEX) -> DataFrame:
    """Accuracy, and the share of labels among the `n` best entries."""
    valid = scored.filter(valid_label(F.col("label"), ignore_index))
    return valid.agg(
        F.try_divide(F.count_if(argmax(F.col("logits")) == F.col("label")), F.count("*")).alias("accuracy"),
        F.try_divide(F.count_if(label_in_top(F.col("logits"), F.col("label"), n)), F.count("*")).alias(f"top{n}_accuracy"),
    )


def with_loss(scored: DataFrame, ignore_index: int = IGNORE_INDEX) -> DataFrame:
    """Valid rows with their negative log likelihood `nll`."""
    valid = scored.filter(valid_label(F.col("label"), ignore_index))
    return valid.withColumn("nll", negative_log_likelihood(F.col("logits"), F.col("label"), ignore_index))


def cross_entropy(scored: DataFrame, ignore_index: int = IGNORE_INDEX) -> DataFrame:
    return with_loss(scored, ignore_index).agg(F.avg("nll").alias("loss"))


def perplexity(losses: DataFrame, loss: str = "loss") -> DataFrame:
    return losses.withColumn("perplexity", F.exp(loss))


def validation_loss(scored: DataFrame, batch: str = "batch_id", token_weighted: bool = False) -> DataFrame:
    """Loss and perplexity; the mean of batch means unless `token_weighted`."""
    losses = with_loss(scored)
    if token_weighted:
        return perplexity(losses.agg(F.avg("nll").alias("loss")))
    means = losses.groupBy(batch).agg(F.avg("nll").alias("loss"))
    return perplexity(means.agg(F.avg("loss").alias("loss")))


def prompt_perplexity(scored: DataFrame, prompt: str = "prompt_id") -> DataFrame:
    return with_loss(scored).groupBy(prompt).agg(F.exp(F.avg("nll")).alias("perplexity"))


def with_nucleus(scored: DataFrame, top_p: float, temperature: float = 1.0, top_k: int | None = None) -> DataFrame:
    """Add `candidates`, the tokens that survive temperature, top-k and top-p."""
    return scored.withColumn("candidates", candidates(F.col("logits"), temperature, top_k, top_p))


def sample_next_token(
    scored: DataFrame,
    row_key: Column,
    temperature: float = 1.0,
    top_k: int | None = None,
    top_p: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """Add `next_token`, drawn from the filtered distribution with a hashed uniform."""
    allowed = scored.withColumn("_allowed", candidates(F.col("logits"), temperature, top_k, top_p))
    return allowed.withColumn("next_token", draw(F.col("_allowed"), uniform_from(digest(seed, row_key)))).drop("_allowed")


# Generated text ---------------------------------------------------------------


def generation_diversity(samples: DataFrame, tokens: Column) -> DataFrame:
    """Per sample: token count, distinct share and character length."""
    counted = samples.withColumn("_tokens", tokens)
    return (
        counted.withColumn("n_tokens", F.size("_tokens"))
        .withColumn("diversity", F.try_divide(F.size(F.array_distinct("_tokens")), F.col("n_tokens")))
        .withColumn("n_chars", F.length("text"))
        .drop("_tokens")
    )


def histogram(values: DataFrame, column: str, width: float) -> DataFrame:
    """Rows per bucket `[k*width, (k+1)*width)`."""
    bucket = F.floor(F.col(column) / F.lit(width)).cast("bigint")
    return values.filter(F.col(column).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def length_correlation(values: DataFrame, length: str = "n_tokens", diversity: str = "diversity") -> DataFrame:
    return values.agg(F.corr(F.col(length).cast("double"), F.col(diversity)).alias("correlation"))


def diversity_by_length(values: DataFrame, width: int, length: str = "n_tokens",
                        diversity: str = "diversity") -> DataFrame:
    bucket = F.floor(F.col(length) / F.lit(width)).cast("bigint")
    return values.groupBy(bucket.alias("bucket")).agg(
        F.avg(diversity).alias("mean_diversity"), F.count("*").alias("n")
    )
