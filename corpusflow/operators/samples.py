"""From raw rows to train, validation and test samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.logits import let
from corpusflow.functions.text import clean_text, length_between
from corpusflow.operators.ordering import PART, head_per_group, head_rows, ordered_layout

MIN_LENGTH = 150
MAX_LENGTH = 500
SMALL_BUNDLE = {"train": 1000, "validation": 100, "test": 100}


def resolve_text_column(df: DataFrame) -> str:
    """`text`, else `story`, else the first column."""
    for name in ("text", "story"):
        if name in df.columns:
            return name
    return df.columns[0]


def with_text_column(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed(resolve_text_column(df), "text")


def non_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(F.coalesce(F.col(column), F.lit("")) != "")


def clean(df: DataFrame) -> DataFrame:
    return df.withColumn("text", clean_text(F.col("text")))


def filter_length(df: DataFrame, shortest: int = MIN_LENGTH, longest: int = MAX_LENGTH) -> DataFrame:
    return df.filter(length_between(F.col("text"), shortest, longest))


def extract_samples(
    df: DataFrame,
    keys: Sequence[str],
    max_samples: int | None = None,
    shortest: int = MIN_LENGTH,
    longest: int = MAX_LENGTH,
) -> DataFrame:
    """Cleaned samples of allowed length among the first `max_samples` rows scanned."""
    named = head_rows(with_text_column(df).select(*keys, "text"), keys, max_samples)
    # A generator cleans each text once, where a filter on the cleaned text would repeat the cleaning.
    fitting = F.filter(F.array(clean_text(F.col("text"))), lambda t: length_between(t, shortest, longest))
    return named.select(*keys, F.explode(fitting).alias("text"))


def validation_cap(max_samples: int | None) -> int | None:
    return None if max_samples is None else int(max_samples * 0.1)


def retention(df: DataFrame, shortest: int = MIN_LENGTH, longest: int = MAX_LENGTH) -> DataFrame:
    """Rows scanned, rows kept by the length filter and their ratio."""
    kept = F.count_if(let(clean_text(F.col("text")), lambda t: length_between(t, shortest, longest)))
    return df.agg(F.count("*").alias("scanned"), kept.alias("kept")).withColumn(
        "rate", F.try_divide(F.col("kept"), F.col("scanned"))
    )


def tail_split(train: DataFrame, keys: Sequence[str], validation: DataFrame | None = None,
               validation_keys: Sequence[str] | None = None) -> DataFrame:
    """Split by position: `(split, sample_no, text)`, `sample_no` counting within the source table.

    Without a validation table its last-5 % stand-in comes from the tail of train.
    More than 100 validation rows give their last half to test; otherwise test is
    the last 5 % of the remaining train rows. A tail of size 0 is empty.
    """
    train_rows = ordered_layout(train.select(*keys, "text"), keys, position="sample_no")
    train_end = train_total = train_rows.count()
    if validation is None:
        size = int(train_total * 0.05)
        train_end -= size
        validation_total = size
    else:
        validation_keys = validation_keys or keys
        validation_rows = ordered_layout(
            validation.select(*validation_keys, "text"), validation_keys, position="sample_no"
        )
        validation_total = validation_rows.count()

    validation_end = validation_total
    test_from_train = validation_total <= 100
    validation_start = train_end
    if test_from_train:
        train_end -= int(train_end * 0.05)
    else:
        validation_end -= int(validation_total * 0.5)

    position = F.col("sample_no")
    in_train = F.when(position < train_end, "train")
    if test_from_train:
        in_train = in_train.when(position < validation_start, "test")
    if validation is None:
        in_train = in_train.when(position < validation_start + validation_end, "validation").otherwise("test")
        return train_rows.select(in_train.alias("split"), "sample_no", "text")
    in_validation = F.when(position < validation_end, "validation").otherwise("test")
    return train_rows.select(in_train.alias("split"), "sample_no", "text").unionByName(
        validation_rows.select(in_validation.alias("split"), "sample_no", "text")
    )


def split_complement(df: DataFrame, keys: Sequence[str], tail: int) -> DataFrame:
    """All rows but the last `tail` in key order."""
    rows = ordered_layout(df, keys)
    return rows.filter(F.col("position") < max(rows.count() - tail, 0)).drop("position", PART)


def split_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("split").agg(F.count("*").alias("samples"))


def head_per_split(samples: DataFrame, keys: Sequence[str], sizes: dict[str, int] | None = None) -> DataFrame:
    return head_per_group(samples, "split", keys, SMALL_BUNDLE if sizes is None else sizes)


def union_files(parts: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Concatenate tables in the given order: `(file_no, line_no, text)`.

    Each part names the keys its rows are ordered by.
    """
    tables = []
    for number, (part, keys) in enumerate(parts):
        rows = ordered_layout(with_text_column(part).select(*keys, "text"), keys, position="line_no")
        tables.append(rows.select(F.lit(number).alias("file_no"), "line_no", "text"))
    return reduce(DataFrame.unionByName, tables)


def tokenizer_corpus(parts: Sequence[tuple[DataFrame, Sequence[str]]], max_examples: int | None = None) -> DataFrame:
    """Non-empty texts of all parts, one cap over all of them in their order.

    Training counts words, so the texts themselves are not ordered: a cap falls
    into one part, and only the keys of that part are.
    """
    texts, left = [], max_examples
    for part, keys in parts:
        rows = non_empty(with_text_column(part).select(*keys, "text"))
        if left is not None:
            found = rows.count()
            rows, left = (rows, left - found) if found <= left else (head_rows(rows, keys, left), 0)
        texts.append(rows.select("text"))
        if left == 0:
            break
    return reduce(DataFrame.unionByName, texts)
