"""Packing documents into sequences of bounded length, with a certificate.

Texts are tokenized in Arrow batches: no token of the tokenizer reaches over a blank,
so a text is the sequence of its blank-separated chunks, and a worker segments each
chunk once and remembers a bounded number of them; a chunk of a word and marks is the
word and the marks, since the tokenizer's patterns part them.

Pieces are packed per partition by best-fit decreasing. Dual feasible functions give
a lower bound for the number of sequences of any packing of the partition; where the
packing meets it, it is certified and stays, but for its emptiest sequence. Partitions
with a gap give up their emptiest sequences, more of them the larger the gap. What is
given up meets in fewer, newly dealt partitions and is packed again, until one
partition holds the rest.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.words import slices
from corpusflow.scratch import materialize

CAPACITY = 4096
END_ID = 1
ITEMS = 50_000  # pieces for which a partition is planned
ROUNDS = 4
GIVEN = 8  # sequences given up for each one above the bound
CHUNKS = 1_000_000  # chunks a worker remembers

Batches = Iterator[pa.RecordBatch]

# Tokens ----------------------------------------------------------------------

_encoders: dict[str, "_Encoder"] = {}


class _Chunks(dict):
    """Numbers of chunks; an unknown one gets the next number and waits in `new`."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: visible Latin-1 ones themselves, others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(others)) for b in range(256)]


# Latin letters that are letters for the tokenizer's patterns and for Python alike, and stay single letters in lower
# case; marks join with each other only. The apostrophe is left out, as it may begin a token of letters.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
_MARKS = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_WORD_AND_MARKS = re.compile(f"(?m)^([{_LETTERS}]+)([{_MARKS}]*)$|^(.+)$")
_BYTES = _byte_letters()
_AS_BYTES = {ord(x): "".join(_BYTES[b] for b in x.encode()) for c in range(0xC0, 0x250) for x in chr(c).lower()}


class _Encoder:
    """Ids of blank-separated chunks; equal to encoding the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.numbers = _Chunks()
        self.parts: dict[str, tuple[int, ...]] = {"": ()}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the memory is that of the texts and of CHUNKS chunks."""
        split = [t.encode().split() for t in texts]
        if len(self.numbers) > CHUNKS:
            self.clear()
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        place = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.numbers.new:
            self._learn(self.numbers.new)
            self.numbers.new.clear()
        starts = self.bounds[place]
        lengths = self.bounds[place + 1] - starts
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = self.flat[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        return np.split(flat, ends[np.cumsum(sizes)][:-1]) if len(split) else []

    def _learn(self, chunks: list[bytes]) -> None:
        """A chunk of Latin letters and marks is the word, in lower case, and then the marks; others are encoded as they are."""
        cut = [(word.lower(), rest or marks) for word, marks, rest in _WORD_AND_MARKS.findall(b"\n".join(chunks).decode())]
        parts = self.parts
        # Such words in lower case pass the normalizer and the word split whole, so the model alone gives their ids.
        tokens = self.model.tokenize
        for word in {word for word, _ in cut}.difference(parts):
            parts[word] = tuple([t.id for t in tokens(word if word.isascii() else word.translate(_AS_BYTES))])
        others = list({rest for _, rest in cut}.difference(parts))
        parts.update(zip(others, (tuple(e.ids) for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False))))
        found = [parts[word] + parts[rest] for word, rest in cut]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        first = len(self.numbers) - len(chunks)
        at = self.bounds[first]
        ends = at + np.cumsum(sizes)
        while ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while len(self.numbers) >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(len(self.bounds), np.int64)])
        self.flat[at : ends[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        self.bounds[first + 1 : first + 1 + len(found)] = ends


def tokenize(texts: list[str], path: str) -> list[np.ndarray]:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path].encode(texts)


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(path: str, capacity: int, id_type: pa.DataType):
    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            rows = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for key, ids in zip(batch.column("doc_id").to_pylist(), tokenize(texts, path)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((key, number, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows))
            kinds = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every row of `df(doc_id, text)`: ids, then END_ID, cut only where longer than `capacity`.

    A null text is empty and has the end token alone.
    """
    kind = df.schema["doc_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return df.select("doc_id", "text").mapInArrow(_cut(tokenizer_path, capacity, id_type), f"doc_id {kind}, {PIECES}")


# Packing ---------------------------------------------------------------------


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the largest bound that a dual feasible function gives.

    The functions: total length; the pair (k drops pieces up to k and counts those
    over capacity - k as whole); and rounding x (j + 1) / capacity down to j-ths,
    exact multiples kept.
    """
    if not len(lengths):
        return 0
    size, n = np.unique(lengths.astype(np.int64), return_counts=True)
    best = -(-int((size * n).sum()) // capacity)
    # Sums over sizes in order, so each k costs a lookup.
    over = np.concatenate((np.cumsum(n[::-1])[::-1], [0]))
    mass = np.concatenate((np.cumsum((size * n)[::-1])[::-1], [0]))
    for k in np.unique(np.concatenate((size[size <= capacity // 2], [0]))):
        whole = np.searchsorted(size, capacity - k, "right")
        low = np.searchsorted(size, k, "right") if k else 0
        best = max(best, int(over[whole]) - (-int(mass[low] - mass[whole]) // capacity))
    for j in range(1, 21):
        scaled = size * (j + 1)
        value = np.where(scaled % capacity == 0, size * j, (scaled // capacity) * capacity)  # in units of 1 / (j capacity)
        best = max(best, -(-int((value * n).sum()) // (j * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; every piece goes where the least room stays."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: a sequence has room for r more tokens
    opened = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, number, opened = capacity, opened, opened + 1
        sequence[i], offset[i] = number, capacity - room
        left = room - size
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(number)
    return sequence, offset


PACKED = "sequence_id bigint, offset bigint, certified boolean"


def _pack(capacity: int, last: bool, names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held, ignore_index=True)
        rows = rows.sort_values(["length", "_row"], ascending=[False, True], ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        sequence, offset = best_fit_decreasing(lengths, capacity)
        count = int(sequence.max()) + 1
        filled = np.bincount(sequence, lengths, count).astype(np.int64)
        stays = np.ones(count, bool)
        if not last:
            gap = count - lower_bound(lengths, capacity)
            emptiest = np.argsort(filled, kind="stable")[: 1 + GIVEN * gap]
            stays[emptiest[filled[emptiest] < capacity]] = False
        # The least row of a sequence names it: unique over all partitions and rounds.
        name = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(name, sequence, rows["_row"].to_numpy(np.int64))
        out = rows[names].copy()
        out["sequence_id"], out["offset"], out["certified"] = name[sequence], offset, stays[sequence]
        yield out

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY, items: int = ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """Add `sequence_id` and `offset` to rows with a `length` of 1 to `capacity`."""
    names = [*rows.columns, "_row"]
    pool = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in pool.schema.fields), PACKED])
    whole = pool.filter(F.col("length") == capacity)
    done = [whole.withColumns({"sequence_id": F.col("_row"), "offset": F.lit(0).cast("bigint")})]
    pool = pool.filter(F.col("length") < capacity)
    left = pool.count()
    number = 0
    while left:
        parts = max(1, -(-left // items))
        number += 1
        last = parts == 1 or number > rounds
        # Rows are dealt by their number, whatever their lengths or sources.
        dealt = pool.repartition(parts, F.xxhash64("_row", F.lit(number)))
        packed = materialize(dealt.mapInPandas(_pack(capacity, last, names), schema), "packed")
        done.append(packed.filter("certified").drop("certified"))
        pool = packed.filter("NOT certified").select(*names)
        left = 0 if last else pool.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("_row")


def pack_documents(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every token piece of `df(doc_id, text)` with its place in a sequence."""
    return pack(pieces(df, tokenizer_path, capacity), capacity)
