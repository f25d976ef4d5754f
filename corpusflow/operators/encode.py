"""Encoding and decoding of whole corpora.

The word split runs in the JVM. A batch of words then crosses to Python once as
an Arrow array; each distinct word of the batch is segmented once and its ids
are gathered to all of its occurrences with array arithmetic. Nothing is
shuffled, so a word that makes up a third of the corpus costs no more than any
other. Without merges a word's ids are those of its bytes, wherever words end, so
the bytes of whole texts are looked up at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.functions.bytelevel import pieces_of, text_of
from corpusflow.functions.packed import pack
from corpusflow.functions.sequences import (
    CLS,
    PAD,
    SEP,
    SPECIAL_TOKENS,
    add_special_tokens,
    attention_mask,
    ids_text,
    pad_ids,
    padded_size,
    repeated_text,
    token_type_ids,
    truncate_ids,
)
from corpusflow.operators.bpe import Tokenizer, merge_ranks, segment

WORDS = "_words"
CACHED_WORDS = 200_000
SLICE_WORDS = 1 << 18  # words of a batch that are gathered at once
SLICE_BYTES = 1 << 20  # bytes of a batch that are looked up at once


def _segmenter(tokenizer: Tokenizer) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Distinct words -> (length of each, all ids in a row), remembering a bounded number of words."""
    base, ranks = tokenizer.ids_of_bytes(), merge_ranks(tokenizer)
    special = {t: [i] for t, i in tokenizer.special_ids().items()}
    cache: dict[str, list[int]] = dict(special)

    def ids_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for word in words.to_pylist():
            ids = cache.get(word)
            if ids is None:
                if len(cache) > CACHED_WORDS:
                    cache.clear()
                    cache.update(special)
                ids = cache[word] = segment(word, base, ranks)
            found.append(ids)
        lengths = np.fromiter((len(i) for i in found), np.int64, len(found))
        return lengths, np.fromiter((x for i in found for x in i), np.int32, int(lengths.sum()))

    return ids_of


def _gather(lengths: np.ndarray, flat: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the runs named by `wanted`; also the offset at which each one starts."""
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    sizes = lengths[wanted]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    positions = np.repeat(starts[wanted] - offsets[:-1], sizes) + np.arange(offsets[-1])
    return flat[positions], offsets


def _encode_words(tokenizer: Tokenizer, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _segmenter(tokenizer)
        for batch in batches:
            lists = batch.column(WORDS)
            ends = lists.offsets.to_numpy()
            kept = [n for n in batch.schema.names if n != WORDS]
            first = 0
            while first < len(lists):  # as many rows as have `SLICE_WORDS` words, one at least
                last = max(int(np.searchsorted(ends, ends[first] + SLICE_WORDS, "right")) - 1, first + 1)
                bounds = ends[first:last + 1]
                words = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
                ids, at = _gather(*ids_of(words.dictionary), words.indices.to_numpy(zero_copy_only=False))
                if at[-1] > np.iinfo(np.int32).max:
                    raise OverflowError("a text has more than 2**31 tokens")
                encoded = pa.ListArray.from_arrays(pa.array(at[bounds - bounds[0]].astype(np.int32)), pa.array(ids))
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), encoded], names=[*kept, name])
                first = last

    return run


def _places_of(token: bytes, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where `token` begins in one of the rows that end at `ends`."""
    found = np.flatnonzero(raw[: max(len(raw) - len(token) + 1, 0)] == token[0])
    for k, byte in enumerate(token[1:], 1):
        found = found[raw[found + k] == byte]
    return found[np.searchsorted(ends, found, "right") == np.searchsorted(ends, found + len(token) - 1, "right")]


def _encode_bytes(tokenizer: Tokenizer, name: str):
    """Ids of texts for a vocabulary without merges: that of each byte, and those of special tokens written in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = np.array(tokenizer.ids_of_bytes(), np.int32)
        special = [(t.encode(), i) for t, i in tokenizer.special_ids().items()]
        for batch in batches:
            texts = batch.column(WORDS).cast(pa.large_string())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2], np.uint8) if at[-1] else np.empty(0, np.uint8)
            kept = [n for n in batch.schema.names if n != WORDS]
            first = 0
            while first < len(texts):  # as many rows as have `SLICE_BYTES` bytes, one at least
                last = max(int(np.searchsorted(at, at[first] + SLICE_BYTES, "right")) - 1, first + 1)
                ends, raw = at[first:last + 1] - at[first], data[at[first]:at[last]]
                ids, left = id_of[raw], None
                for token, number in special:
                    places = _places_of(token, raw, ends)
                    if len(places):
                        left = np.ones(len(raw), bool) if left is None else left
                        ids[places] = number
                        left[places[:, None] + np.arange(1, len(token))] = False
                if left is not None:
                    ids, ends = ids[left], np.concatenate(([0], np.cumsum(left)))[ends]
                if ends[-1] > np.iinfo(np.int32).max:
                    raise OverflowError("a text has more than 2**31 tokens")
                encoded = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                rows = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in kept), encoded], names=[*kept, name])
                first = last

    return run


def _encoding(df: DataFrame, tokenizer: Tokenizer, name: str):
    """Rows with what is encoded of their text, and the function over their Arrow batches."""
    kept, text = [c for c in df.columns if c != "text"], F.coalesce("text", F.lit(""))
    if tokenizer.merges:
        return df.select(*kept, pieces_of(text).alias(WORDS)), _encode_words(tokenizer, name)
    return df.select(*kept, F.make_valid_utf8(text).alias(WORDS)), _encode_bytes(tokenizer, name)


def encode_ids(df: DataFrame, tokenizer: Tokenizer, name: str = "ids") -> DataFrame:
    """Replace `text` by its token ids, without special tokens around it."""
    rows, run = _encoding(df, tokenizer, name)
    kept = [f for f in df.schema.fields if f.name != "text"]
    return rows.mapInArrow(run, T.StructType([*kept, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def encode_packed(df: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Replace `text` by `ids`, special tokens included, as `pack` writes them, and `n_tokens`."""
    rows, run = _encoding(df, tokenizer, "ids")
    around = [np.array([special_id(tokenizer, which)], np.int32) for which in (CLS, SEP)]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            lists, kept = batch.column("ids"), batch.schema.names[:-1]
            ends, ids = lists.offsets.to_numpy(), lists.values.to_numpy()
            found = [pack(np.concatenate((around[0], ids[low:high], around[1]))) for low, high in zip(ends, ends[1:])]
            columns = [pa.array(found, pa.binary()), pa.array(np.diff(ends).astype(np.int64) + 2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *columns], names=[*kept, "ids", "n_tokens"])

    kept = [f for f in df.schema.fields if f.name != "text"]
    added = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    return rows.mapInArrow(packed, T.StructType([*kept, *added]))


def encode_with(df: DataFrame, encode: Callable[[pd.Series], pd.Series], name: str = "ids") -> DataFrame:
    """As `encode_ids` with the caller's own tokenizer: texts to lists of ids, a batch at a time."""
    udf = F.pandas_udf(encode, T.ArrayType(T.IntegerType()))
    return df.withColumn(name, udf(F.coalesce("text", F.lit("")))).drop("text")


def encode_words(words: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Segmentation `(word, cnt, ids)` of a table of distinct words."""
    lists = words.withColumn(WORDS, F.array("word"))
    schema = T.StructType([*words.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return lists.mapInArrow(_encode_words(tokenizer, "ids"), schema)


def as_encoding(ids: Column, max_length: int | Column | None, padding: bool, pad: int = PAD, text: bool = False) -> list[Column]:
    """Columns input_ids, token_type_ids and attention_mask, padded if wanted; with `text` as space-separated text."""
    length = max_length if padding else None
    if text:
        own = F.size(ids)
        return [ids_text(ids, length, pad).alias("input_ids"), repeated_text(0, padded_size(own, length)).alias("token_type_ids"),
                F.ltrim(F.concat(repeated_text(1, own), F.repeat(F.lit(" 0"), padded_size(own, length) - own))).alias("attention_mask")]
    columns = [(ids, "input_ids", pad), (token_type_ids(ids), "token_type_ids", 0),
               (attention_mask(ids), "attention_mask", 0)]
    return [pad_ids(c, length, fill).alias(n) for c, n, fill in columns]


def special_id(tokenizer: Tokenizer, which: int) -> int:
    """Where the vocabulary has the special token CLS, SEP, MASK or PAD."""
    name = SPECIAL_TOKENS[which]
    found = tokenizer.special_ids()
    if name not in found:
        raise ValueError(f"the vocabulary has no {name}")
    return found[name]


def with_special(ids: Column, tokenizer: Tokenizer) -> Column:
    return add_special_tokens(ids, special_id(tokenizer, CLS), special_id(tokenizer, SEP))


def encode_corpus(
    df: DataFrame,
    tokenizer: Tokenizer,
    special_tokens: bool = True,
    truncation: bool = False,
    max_length: int | None = None,
    padding: bool = False,
) -> DataFrame:
    """Encode every row; `padding` needs a `max_length`, as there is no batch to measure."""
    encoded = _finished(df, tokenizer, special_tokens, max_length if truncation else None)
    pad = special_id(tokenizer, PAD) if padding else PAD
    return encoded.select(*others(df), *as_encoding(F.col("ids"), max_length, padding, pad))


def encode_batches(
    df: DataFrame,
    tokenizer: Tokenizer,
    batch: str = "batch_id",
    special_tokens: bool = True,
    truncation: bool = False,
    max_length: int | None = None,
    padding: bool = False,
    text: bool = False,
) -> DataFrame:
    """Encode rows that belong to batches; without `max_length` each batch is padded to its longest row."""
    encoded, length, pad = batch_ids(df, tokenizer, batch, special_tokens, truncation, max_length, padding)
    return encoded.select(*others(df), *as_encoding(F.col("ids"), length, padding, pad, text))


def batch_ids(
    df: DataFrame,
    tokenizer: Tokenizer,
    batch: str = "batch_id",
    special_tokens: bool = True,
    truncation: bool = False,
    max_length: int | None = None,
    padding: bool = False,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, int | Column | None, int]:
    """Rows with their `ids` before padding, the length to pad them to and the padding id.

    The length of a batch is found from sizes alone and joined to its texts, which are then
    encoded again: ids, several times as large, and what `derive` adds to them never cross a shuffle.
    """
    length: int | Column | None = max_length
    if padding and max_length is None:
        sizes = _finished(df.select(batch, "text"), tokenizer, special_tokens, None).select(F.col(batch).alias("_batch"), F.size("ids").alias("_size"))
        longest = sizes.groupBy("_batch").agg(F.max("_size").alias("batch_length"))
        df = df.join(longest, F.col(batch).eqNullSafe(F.col("_batch"))).drop("_batch")
        length = F.col("batch_length")
    encoded = _finished(df, tokenizer, special_tokens, max_length if truncation else None)
    encoded = derive(encoded) if derive else encoded
    return encoded, length, special_id(tokenizer, PAD) if padding else PAD


def with_batch_length(encoded: DataFrame, batch: str = "batch_id", ids: str = "ids") -> DataFrame:
    """Add `batch_length`, the longest row of the batch; a batch holds `batch_size` rows."""
    return encoded.withColumn("batch_length", F.max(F.size(ids)).over(Window.partitionBy(batch)))


def _finished(df: DataFrame, tokenizer: Tokenizer, special_tokens: bool, cut: int | None) -> DataFrame:
    encoded = encode_ids(df, tokenizer)
    ids = with_special(F.col("ids"), tokenizer) if special_tokens else F.col("ids")
    return encoded.withColumn("ids", truncate_ids(ids, cut))


def others(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "text"]


def decode_corpus(df: DataFrame, tokenizer: Tokenizer, ids: str = "ids", skip_special: bool = True) -> DataFrame:
    """Replace `ids` by `text`."""
    skip = set(tokenizer.special_ids().values()) if skip_special else set()
    others = [c for c in df.columns if c != ids]
    return df.select(*others, text_of(F.col(ids), list(tokenizer.tokens), skip).alias("text"))


def roundtrip_audit(df: DataFrame, tokenizer: Tokenizer, max_length: int | None = None) -> DataFrame:
    """Rows whose text survives encoding, truncation and decoding, case and spaces aside: `(matches, n)`."""
    kept = df.select("text", F.col("text").alias("original"))
    encoded = encode_ids(kept, tokenizer)
    if max_length is not None:
        encoded = encoded.withColumn("ids", truncate_ids(F.col("ids"), max_length))
    decoded = decode_corpus(encoded, tokenizer)
    same = _bare(F.col("text")) == _bare(F.col("original"))
    return decoded.groupBy(same.alias("matches")).agg(F.count("*").alias("n"))


def _bare(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit(""))
