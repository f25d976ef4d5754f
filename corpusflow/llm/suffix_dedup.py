"""Removing byte strings of a fixed length that occur more than once in a corpus.

This is a substitute for the merge of shard Burrows-Wheeler transforms by interleave
refinement: no transform, interleave or common prefix array is built, and suffixes are
never sorted. Strings are grouped by minimizers, blocks of them are counted by 64-bit
hash, and a block is refined only while it has two members. The transforms were not
tried; the README has an estimate of what they would take, and no measurement.

A string of LENGTH bytes starting at p is represented by the place a(p), the least
hash of GRAM bytes among the places p to p + REACH - 1 (the last one on ties). Equal
strings have it at the same distance, so all places with the same representative
share one suffix, and there is one for about REACH / 2 bytes.

1. Blocks by the suffix at a(p), as far as every string of the group reaches. A block
   with one member has no repeated string and is dropped.
2. Blocks by the whole group: from its first place to the end of its last string. A
   block with two members is repeated at every place.
3. Only where a block of step 1 has members that step 2 leaves single, each place is
   a block of its own, by its whole string; members that agree in step 2 are read once.

The removed bytes of a text are the union of the repeated strings. Hashes have 64
bits. Everything is counted by hash, with partial sums, so a passage that a third of
the texts share makes one group per task; texts are shuffled once, those without a
repeated suffix not again.

A null text is empty. Texts shorter than the length lose nothing. Repeated rows are
repeated texts: all their bytes go, if they are long enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.words import Ranges, data, offsets, slices
from corpusflow.scratch import materialize

LENGTH = 400
GRAM = 32
REACH = 128

_U = np.uint64
Batches = Iterator[pa.RecordBatch]


def least_in_reach(values: np.ndarray, reach: int) -> np.ndarray:
    """Least of each `reach` values in a row, by running minima of blocks from both sides."""
    n = len(values) - reach + 1
    padded = np.full(-(-len(values) // reach) * reach, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[reach - 1 : reach - 1 + n])


class Groups:
    """The places of a batch of texts at which a string of `length` bytes starts, grouped by their representative."""

    def __init__(self, texts: pa.Array, length: int, gram: int, reach: int):
        self.at, raw = offsets(texts), data(texts)
        self.ranges = Ranges(raw)
        self.length = length
        n = len(raw)
        if n < length:
            self.low = self.high = self.owner = np.zeros(0, np.int64)
            self.core = self.whole = np.zeros(0, np.int64)
            return
        places = np.arange(n - gram + 1)
        hashes = self.ranges.hash(places, places + gram)
        ranked = (hashes & _U(0xFFFFFFFF00000000)) | (_U(0xFFFFFFFF) - places.astype(np.uint64))
        chosen = _U(0xFFFFFFFF) - (least_in_reach(ranked, reach) & _U(0xFFFFFFFF))
        chosen = chosen.astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), np.diff(self.at))[: n - length + 1]
        start = np.flatnonzero(np.arange(n - length + 1) + length <= self.at[owner + 1])
        chosen, owner = chosen[start], owner[start]
        first = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])]) if len(start) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(start)][: len(first)] - 1
        self.low, self.high, self.owner = start[first], start[last], owner[first]
        reached = length - reach + 1
        self.core = self.ranges.hash(chosen[first], chosen[first] + reached).view(np.int64)
        self.whole = self.ranges.hash(self.low, self.high + length).view(np.int64)


def _cores(sizes: tuple[int, int, int]):
    """Distinct suffix blocks of a slice with their number of members."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            blocks, n = np.unique(Groups(batch.column("text"), *sizes).core, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(n)], names=["core", "n"])

    return run


def _groups(sizes: tuple[int, int, int]):
    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            g = Groups(batch.column("text"), *sizes)
            begin = g.at[g.owner]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(g.owner)), pa.array((g.low - begin).astype(np.int32)),
                 pa.array((g.high - begin).astype(np.int32)), pa.array(g.core), pa.array(g.whole)],
                names=["key", "low", "high", "core", "whole"])

    return run


def _strings(length: int):
    """Hashes of the whole strings at the open places of each text."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            raw = Ranges(data(batch.column("text")))
            begin = offsets(batch.column("text"))[:-1]
            lists = batch.column("open")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            runs = lists.flatten()
            low, high = (runs.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            sizes = high - low + 1
            ends = np.cumsum(sizes)
            places = np.repeat(low - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
            members = np.repeat(runs.field(2).to_numpy(), sizes)
            owner = np.repeat(owner, sizes)
            start = begin[owner] + places
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(owner)), pa.array(places.astype(np.int32)), pa.array(members),
                 pa.array(raw.hash(start, start + length).view(np.int64))],
                names=["key", "low", "n", "string"])

    return run


def runs_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by spans; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _cut(batches: Batches) -> Batches:
    for batch in slices(batches):
        rows = []
        for key, text, spans in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw, left, kept = text.encode(), 0, hashlib.sha256()
            removed = runs_of([(s["low"], s["end"]) for s in spans])
            for low, high in removed:
                kept.update(raw[left:low])
                left = high
            kept.update(raw[left:])
            rows.append({"key": key, "runs": [{"low": a, "end": b} for a, b in removed], "kept_sha256": kept.hexdigest()})
        run = pa.list_(pa.struct([("low", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.int64()), ("runs", run), ("kept_sha256", pa.string())]))


RUNS = "array<struct<low:int,end:int>>"


def repeated_runs(df: DataFrame, length: int = LENGTH, gram: int = GRAM, reach: int = REACH, key: str = "doc_id") -> DataFrame:
    """`(key, n_bytes, runs, kept_sha256)` for every row of `df(key, text)`: the removed byte runs and the digest of the rest."""
    if not gram <= length - reach + 1:
        raise ValueError("a string must hold every gram within reach")
    sizes = (length, gram, reach)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(F.col(key), text.alias("text")).select(key, "text", F.xxhash64("text").alias("key"))
    long = rows.select("key", "text").filter(F.octet_length("text") >= length)

    cores = long.mapInArrow(_cores(sizes), "core bigint, n bigint").groupBy("core").agg(F.sum("n").alias("n")).filter("n > 1").select("core")
    groups = long.mapInArrow(_groups(sizes), "key bigint, low int, high int, core bigint, whole bigint")
    shared = materialize(groups.join(cores, "core", "left_semi"), "groups")

    # One member stands for all groups that agree as a whole.
    one = F.min(F.struct("key", "low", "high")).alias("one")
    wholes = materialize(shared.groupBy("core", "whole").agg(F.count("*").alias("n"), one), "wholes")
    repeated = wholes.filter("n > 1").select("core", "whole")
    known = shared.join(repeated, ["core", "whole"], "left_semi").select("key", "low", (F.col("high") + length).alias("end"))
    open_ = wholes.groupBy("core").agg(F.bool_or(F.col("n") == 1).alias("open"), F.sum("n").alias("n")).filter("open AND n > 1").select("core")
    asked = wholes.join(open_, "core", "left_semi").select("one.*", F.least("n", F.lit(2)).cast("int").alias("n"))
    places = asked.groupBy("key").agg(F.collect_set(F.struct("low", "high", "n")).alias("open"))

    touched = shared.select("key").distinct()
    small = materialize(long.join(touched, "key", "left_semi").dropDuplicates(["key"]), "texts")
    strings = materialize(small.join(places, "key").mapInArrow(_strings(length), "key bigint, low int, n int, string bigint"), "strings")
    twice = strings.groupBy("string").agg(F.sum("n").alias("n")).filter("n > 1").select("string")
    single = strings.filter("n = 1").join(twice, "string", "left_semi").select("key", "low", (F.col("low") + length).alias("end"))

    spans = known.unionByName(single).groupBy("key").agg(F.collect_set(F.struct("low", "end")).alias("spans"))
    found = materialize(small.join(spans, "key").mapInArrow(_cut, f"key bigint, runs {RUNS}, kept_sha256 string"), "runs")
    plain = rows.select(key, "key", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.encode("text", "UTF-8"), 256).alias("_all"))
    return plain.join(found, "key", "left").select(
        key, "n_bytes", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), F.coalesce("kept_sha256", "_all").alias("kept_sha256"))
