"""The three jobs a user runs end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.operators.bpe import Tokenizer, train_bpe
from corpusflow.operators.samples import (
    MAX_LENGTH,
    MIN_LENGTH,
    extract_samples,
    tail_split,
    tokenizer_corpus,
    validation_cap,
)
from corpusflow.operators.windows import (
    assign_batches,
    encoded_stream,
    place_batches,
    shuffle_examples,
    sliding_windows,
    split_window,
    window_count,
)
from corpusflow.scratch import materialize

SMALL_IDS = 1 << 15  # as many ids fit into a smallint


def create_dataset_splits(
    train: DataFrame,
    keys: Sequence[str],
    validation: DataFrame | None = None,
    validation_keys: Sequence[str] | None = None,
    max_samples: int | None = None,
    shortest: int = MIN_LENGTH,
    longest: int = MAX_LENGTH,
) -> DataFrame:
    """Raw rows to `(split, sample_no, text)`."""
    # Written once: ordering samples its input, and the kept rows are far fewer than the scanned ones.
    samples = materialize(extract_samples(train, keys, max_samples, shortest, longest), "samples")
    if validation is None:
        return tail_split(samples, keys)
    validation_keys = validation_keys or keys
    cap = validation_cap(max_samples)
    held_out = materialize(extract_samples(validation, validation_keys, cap, shortest, longest), "held-out")
    return tail_split(samples, keys, held_out, validation_keys)


def train_tokenizer(parts: Sequence[tuple[DataFrame, Sequence[str]]], vocab_size: int = 5000, min_frequency: int = 2,
                    max_examples: int | None = None) -> Tokenizer:
    """Tokenizer from the texts of all parts."""
    return train_bpe(tokenizer_corpus(parts, max_examples), vocab_size, min_frequency)


def make_training_batches(
    samples: DataFrame,
    keys: Sequence[str],
    tokenizer: Tokenizer,
    seq_length: int = 128,
    batch_size: int = 16,
    stride: int = 1,
    training: bool = True,
    seed: int = 0,
    epoch: int = 0,
    collate: dict[str, Column] | None = None,
    sort: bool = True,
) -> DataFrame:
    """`(batch_id, slot, window_start, input_ids, labels)`, and the columns that `collate` computes from these.

    Training examples are shuffled and an incomplete last batch is dropped;
    otherwise they stay in stream order and all are kept. Stride 1 repeats every
    token `seq_length` times; a stride of `seq_length` repeats none.

    With `sort` the shuffled order is that of hashed keys, which range partitions the
    windows. Without it a keyed permutation gives each window its place, and the
    windows stay where they were cut.
    """
    stream = encoded_stream(samples, keys, tokenizer)
    if tokenizer.vocab_size <= SMALL_IDS:  # ids cross each shuffle in two bytes
        stream = stream.withColumn("ids", F.col("ids").cast("array<smallint>"))
    windows = sliding_windows(stream, seq_length, stride, joined=True)
    if training and sort:
        shuffled = shuffle_examples(windows, seed=seed, epoch=epoch)
        shuffled = shuffled.withColumn("shuffle_key", F.unhex("shuffle_key"))  # half the bytes in the same order
        batches = assign_batches(shuffled, ["shuffle_key", "window_start"], batch_size, drop_last=True)
    else:
        count = window_count(stream, seq_length, stride) if training else 0
        batches = place_batches(windows, count, stride, batch_size, (seed, epoch) if training else None)
    batches = split_window(batches.select("batch_id", "slot", "window_start", "tokens"), seq_length)
    return batches.withColumns(collate) if collate else batches
