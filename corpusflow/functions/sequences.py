"""Building blocks for training examples, on arrays of token ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.hashing import position_digests
from corpusflow.functions.logits import IGNORE_INDEX

# The special tokens and their ids.
SPECIAL_TOKENS = ("[CLS]", "[SEP]", "[MASK]", "[PAD]")
CLS, SEP, MASK, PAD = 0, 1, 2, 3
DRAWN_TOKENS = 1 << 15  # tokens that are masked at once


def add_special_tokens(ids: Column, first: int = CLS, last: int = SEP) -> Column:
    return F.concat(F.array(F.lit(first)), ids, F.array(F.lit(last)))


def truncate_ids(ids: Column, max_length: Column | int | None) -> Column:
    """Cut at `max_length`. Applied after the special tokens, so the closing one may go."""
    return ids if max_length is None else F.slice(ids, F.lit(1), _as_column(max_length))


def pad_ids(ids: Column, max_length: Column | int | None, fill: int = PAD) -> Column:
    """Fill up to `max_length`; longer rows stay as they are."""
    if max_length is None:
        return ids
    missing = F.greatest(_as_column(max_length) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(fill), missing))


def padded_size(size: Column, max_length: Column | int | None) -> Column:
    """Size of `pad_ids` of so many ids."""
    return size if max_length is None else F.greatest(_as_column(max_length), size)


def repeated_text(value: int, n: Column) -> Column:
    """`n` times the same id as space-separated text."""
    return F.ltrim(F.repeat(F.lit(f" {value}"), n))


def ids_text(ids: Column, max_length: Column | int | None = None, fill: int = PAD) -> Column:
    """`pad_ids` as space-separated text: padding is repeated as text, never as array elements."""
    text = F.array_join(ids.cast("array<string>"), " ")
    if max_length is None:
        return text
    return F.ltrim(F.concat(text, F.repeat(F.lit(f" {fill}"), padded_size(F.size(ids), max_length) - F.size(ids))))


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def token_type_ids(ids: Column) -> Column:
    return F.array_repeat(F.lit(0), F.size(ids))


def _as_column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def is_special(token_id: Column) -> Column:
    """CLS, SEP and PAD; the mask token may be masked again."""
    return token_id.isin(CLS, SEP, PAD)


def next_token_labels(ids: Column, label_pad_id: int = PAD) -> Column:
    """Ids shifted left by one, closed by the padding label."""
    shifted = F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))
    return F.concat(shifted, F.array(F.lit(label_pad_id)))


def mask_tokens(ids: Column, row_key: Column, vocab_size: int, mask_prob: float = 0.15, seed: int = 0) -> Column:
    """Masked copy of `ids`: of the drawn tokens 80 % MASK, 10 % a random id, 10 % unchanged.

    Each position draws from a digest of seed, row and position, as `hashing.digest` and
    `hashing.uniform_from` give them; an Arrow batch takes them from all of its rows at once.
    """

    def masked(lists: pa.Array, keys: pa.Array) -> pa.Array:
        bounds = lists.offsets.to_numpy()
        tokens = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False).copy()
        sizes = np.diff(bounds).astype(np.int64)
        prefixes = [f"{seed}|" if key is None else f"{seed}|{key}|" for key in keys.to_pylist()]
        for first in range(0, len(tokens), DRAWN_TOKENS):
            part = tokens[first:first + DRAWN_TOKENS]  # a view
            places = first + np.flatnonzero(~np.isin(part, (CLS, SEP, PAD)))
            rows = np.searchsorted(bounds - bounds[0], places, "right") - 1
            codes = position_digests(prefixes, rows, places - (bounds[rows] - bounds[0]))
            draws = codes / float(1 << 32)
            random_id = np.floor(draws[3] * vocab_size).astype(np.int32)
            changed = np.where(draws[1] < 0.8, MASK, np.where(draws[2] < 0.5, random_id, tokens[places]))
            tokens[places] = np.where(draws[0] < mask_prob, changed, tokens[places])
        ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens, pa.int32()), mask=lists.is_null())

    return F.arrow_udf(masked, "array<int>")(ids, row_key.cast("string"))


def masked_labels(ids: Column, masked: Column, only_changed: bool = False) -> Column:
    """The original ids; with `only_changed` the positions left alone are ignored."""
    if not only_changed:
        return ids
    return F.zip_with(ids, masked, lambda old, new: F.when(old != new, old).otherwise(F.lit(IGNORE_INDEX)))


def count_of(ids: Column, token_id: int) -> Column:
    return F.size(ids) - F.size(F.array_remove(ids, token_id))
