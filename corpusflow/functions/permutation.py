"""A keyed permutation of 0 .. n-1 as a column expression, so that a shuffle needs no sort.

Rounds of swap-or-not (Hoang, Morris and Rogaway, 2012): every round pairs x with
(turn - x) mod n and swaps the two or leaves both, by a keyed bit of the larger. Each
round is its own inverse, so it is a permutation for any n, without numbers beyond n.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 48
# Odd multipliers below 2**31, so that products of 31 bits stay within a bigint.
FIRST, SECOND = 0x5BD1E995, 0x2C1B3C6D
MASK = (1 << 31) - 1


def round_keys(seed: int, epoch: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Turn and bit key of each round, from the digest of seed, epoch and round."""
    digests = [hashlib.md5(f"{seed}|{epoch}|{r}".encode()).hexdigest() for r in range(rounds)]
    return [(int(d[:15], 16), int(d[15:23], 16) & MASK) for d in digests]


def permuted(index: Column, n: Column | int, seed: int = 0, epoch: int = 0, rounds: int = ROUNDS) -> Column:
    """Place of `index` (0 .. n-1) in the order of this seed and epoch; `n` up to 2**61."""
    n = F.lit(n).cast("bigint") if isinstance(n, int) else n.cast("bigint")
    keys = round_keys(seed, epoch, rounds)

    def places(indexes: pa.Array, sizes: pa.Array) -> pa.Array:
        valid = pc.and_(indexes.is_valid(), sizes.is_valid())
        x = pc.if_else(valid, indexes, 0).to_numpy(zero_copy_only=False)
        size = pc.if_else(valid, sizes, 1).to_numpy(zero_copy_only=False)
        for turn, key in keys:
            other = (turn % size - x) % size
            x = np.where(_bit(np.maximum(x, other), key) == 1, other, x)
        return pc.if_else(valid, pa.array(x, pa.int64()), None)

    # Not to be moved: a filter on the place, pushed below the cut of windows, would carry whole blocks of tokens.
    return F.arrow_udf(places, "bigint").asNondeterministic()(index.cast("bigint"), n)


def _bit(x: np.ndarray, key: int) -> np.ndarray:
    folded = x & MASK ^ x >> 31 ^ key
    mixed = folded * FIRST & MASK
    mixed ^= mixed >> 15
    mixed = mixed * SECOND & MASK
    return mixed >> 17 & 1
