"""Aligning the tokens of two tokenizers over the bytes of a text.

The ends of the tokens of both sides, counted in bytes, are dictionaries from end to
index. The keys they share, sorted, slice both id lists into groups that cover the
same bytes; inside a group, tokens whose byte ranges overlap are linked.

A text is cut before a blank or line end that stands alone between other characters.
Both tokenizers end a token there, so a part is aligned once for all its occurrences
in a worker's memory, all new parts of a slice in one row. Other runs of blanks are
never cut through.

Counts over the corpus are a product of a sparse matrix with a vector: a slice of
documents keeps its distinct id pairs and which part of which text holds them; pairs
of all slices are summed per id pair, joined back, and meet their slice again, whose
size is bounded by SLICE_BYTES and its longest text.

A null or empty text, and one whose tokens do not spell it (as when it holds the
piece model's own mark for a blank), has no tokens, only zeros. Repeated rows and
repeated ids are rows of their own; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusflow.functions.bytelevel import byte_characters
from corpusflow.llm.words import slices
from corpusflow.scratch import materialize

SLICE_BYTES = 3 << 20
PARTS = 150_000  # parts a worker remembers
PART_BYTES = 32 << 20  # and the text they may hold together
AT_ONCE = 10_000  # parts that are learned together
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

Batches = Iterator[pa.RecordBatch]

# Two tokenizers ----------------------------------------------------------------


class Pair:
    """A byte-level BPE over blank + text, and a piece model that adds this blank itself."""

    def __init__(self, bytes_path: str, pieces_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(bytes_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        letters = {c: bytes([i]) for i, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = b"".join(letters.get(c, c.encode()) for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # Parts may be tokenized apart where no piece reaches over the cut: before a blank, around a line end.
        if any(re.search(r"[^▁]▁|\n.|.\n", p) for i, p in enumerate(pieces) if not self.b.is_byte(i)):
            raise ValueError("pieces reach over blanks or line ends")

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids on both sides of parts that begin with a blank or a line end."""
        left = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        # The model puts a blank before what it is given: the part's own, or one that no piece joins with a line end.
        right = self.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        return left, [ids if p[0] == " " else ids[1:] for p, ids in zip(parts, right)]


def cut(text: str) -> list[str]:
    """Parts of blank + text that may be aligned apart; a part without a blank or line end before it lacks its blank."""
    if text.replace("\n", " ").split(" ") == text.split():  # every blank and line end stands alone
        return text.replace("\n", " \n").split(" ")
    return CUT.split(" " + text)


def align(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of tokens of these byte sizes, which add up to the same number.

    Returns the end of each group in bytes, in tokens of both sides, and the indexes
    of the linked tokens. Inside a group an end of either side closes one overlap, of
    the two tokens that reach up to it.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_index = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1)))
    b_index = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1)))
    shared = sorted(a_index.keys() & b_index.keys())
    a_stop = np.fromiter(map(a_index.__getitem__, shared), np.int64, len(shared))
    b_stop = np.fromiter(map(b_index.__getitem__, shared), np.int64, len(shared))
    ends = np.union1d(a_ends, b_ends)
    return np.array(shared, np.int64), a_stop, b_stop, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)


# Parts of a worker --------------------------------------------------------------


class _Numbers(dict):
    """An unknown key gets the next number."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class _Parts:
    """What aligned parts come to, by number; forgotten together when there are too many."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side], np.int64) for side in (pair.a_bytes, pair.b_bytes))
        spell = lambda n, end: np.array([f"{i}{end}" for i in range(n)], object)
        self.a_text = spell(len(self.a_sizes), ","), spell(len(self.a_sizes), "|")
        self.b_text = spell(len(self.b_sizes), ","), spell(len(self.b_sizes), ";")
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.size = 0
        self.known = np.zeros(0, bool)
        self.counts = np.zeros((0, len(REPORT)), np.int32)
        self.text: list[str] = []
        self.codes = np.zeros(0, np.int64)  # a << 32 | b of each link
        self.bounds = np.zeros(1, np.int64)  # where the links of each part begin

    def numbered(self, parts: Iterable[str]) -> np.ndarray:
        found = np.fromiter(map(self.numbers.__getitem__, parts), np.int64)
        new = list(islice(self.numbers, len(self.text), None))
        learned = [self._learn(new[low : low + AT_ONCE]) for low in range(0, len(new), AT_ONCE)]
        if learned:
            self.size += sum(map(len, new))
            known, counts, codes = (np.concatenate((old, *more)) for old, more in zip((self.known, self.counts, self.codes), zip(*learned)))
            self.known, self.counts, self.codes = known, counts, codes
            self.bounds = np.concatenate(([0], np.cumsum(counts[:, -1], dtype=np.int64)))
        return found

    def _learn(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        parts = [p if p[:1] in (" ", "\n") else " " + p for p in parts]
        a, b = self.pair.encode(parts)
        n_a, n_b = (np.fromiter(map(len, side), np.int64, len(parts)) for side in (a, b))
        a_ids, b_ids = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
        known = self._spelled(parts, a_ids, n_a, self.pair.a_bytes) & self._spelled(parts, b_ids, n_b, self.pair.b_bytes)
        a_ids, b_ids = a_ids[np.repeat(known, n_a)], b_ids[np.repeat(known, n_b)]
        n_a, n_b = n_a * known, n_b * known
        shared, a_stop, b_stop, link_a, link_b = align(self.a_sizes[a_ids], self.b_sizes[b_ids])
        # One list of texts: the tokens of a group on the one side, then on the other.
        a_last, b_last = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
        a_last[a_stop - 1] = b_last[b_stop - 1] = True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        spelled = np.empty(len(a_ids) + len(b_ids), object)
        before = np.concatenate(([0], b_stop))
        for ids_, last, text, place in (
            (a_ids, a_last, self.a_text, np.arange(len(a_ids)) + before[a_group]),
            (b_ids, b_last, self.b_text, np.arange(len(b_ids)) + a_stop[b_group] if len(b_ids) else np.zeros(0, np.int64)),
        ):
            spelled[place] = np.where(last, text[1][ids_], text[0][ids_])
        words, stops = spelled.tolist(), np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(words[low:high]) for low, high in zip([0, *stops], stops)]
        # Parts end where their tokens end, and so do groups and links.
        a_stops = np.cumsum(n_a)
        links = np.searchsorted(link_a, a_stops)
        groups = np.searchsorted(a_stop, a_stops, "right")
        counts = np.stack([n_a, n_b, np.diff(groups, prepend=0), np.diff(links, prepend=0)], 1).astype(np.int32)
        return known, counts, a_ids[link_a] << 32 | b_ids[link_b]

    def _spelled(self, parts: list[str], ids: np.ndarray, counts: np.ndarray, tokens: list[bytes]) -> np.ndarray:
        """Which parts their ids spell; one comparison does where all are."""
        found = list(map(tokens.__getitem__, ids.tolist()))
        stops = np.cumsum(counts).tolist()
        if b"".join(found) == "".join(parts).encode():
            sizes = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
            if np.array_equal(np.cumsum([len(p.encode()) for p in parts]), np.concatenate(([0], sizes))[stops]):
                return np.ones(len(parts), bool)
        return np.array([b"".join(found[low:high]) == p.encode() for p, low, high in zip(parts, [0, *stops], stops)], bool)

    def links(self, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the links of these parts, one part after the other, and how many each has."""
        lengths = self.bounds[used + 1] - self.bounds[used]
        begins = np.cumsum(lengths) - lengths
        return self.codes[np.repeat(self.bounds[used] - begins, lengths) + np.arange(lengths.sum())], lengths


_workers: dict[tuple[str, str], _Parts] = {}


def _parts(bytes_path: str, pieces_path: str) -> _Parts:
    if (bytes_path, pieces_path) not in _workers:
        _workers[bytes_path, pieces_path] = _Parts(Pair(bytes_path, pieces_path))
    return _workers[bytes_path, pieces_path]


REPORT = ("n_a", "n_b", "n_groups", "n_links")


def _align_slices(bytes_path: str, pieces_path: str, slice_bytes: int, names: list[str]):
    """Per slice of documents: the report of each, its parts, and the distinct id pairs of these parts."""

    def run(batches: Batches) -> Batches:
        for batch in slices(batches, size=slice_bytes):
            held = _parts(bytes_path, pieces_path)
            if len(held.text) > PARTS or held.size > PART_BYTES:
                held.clear()
            split = [cut(t) if t else [] for t in batch.column("text").to_pylist()]
            lengths = np.fromiter(map(len, split), np.int64, len(split))
            flat = held.numbered(chain.from_iterable(split))
            row_of = np.repeat(np.arange(len(split)), lengths)
            # A text with a part that its tokens do not spell has none.
            spelled = np.ones(len(split), bool)
            spelled[row_of[~held.known[flat]]] = False
            flat, row_of, lengths = flat[spelled[row_of]], row_of[spelled[row_of]], np.where(spelled, lengths, 0)
            report = [np.bincount(row_of, held.counts[flat, k], len(split)).astype(np.int64) for k in range(len(REPORT))]
            text, stops = list(map(held.text.__getitem__, flat.tolist())), np.cumsum(lengths).tolist()
            joined = ["".join(text[low:high]) for low, high in zip([0, *stops], stops)]
            hashes = [hashlib.sha256(t[:-1].encode()).hexdigest() if t else "" for t in joined]  # groups end with a semicolon
            # Parts as places among those of the slice, their links as places among the slice's distinct pairs.
            times = np.bincount(flat, minlength=len(held.text))
            used = np.flatnonzero(times)
            order = np.cumsum(times > 0) - 1
            codes, link_counts = held.links(used)
            code, place = np.unique(codes, return_inverse=True)
            total = np.bincount(place, np.repeat(times[used], link_counts), len(code)).astype(np.int64)
            pairs = pa.StructArray.from_arrays([pa.array(code), pa.array(total)], ["code", "n"])
            lists = [
                *[batch.column(n) for n in names], *map(pa.array, report), pa.array(hashes, pa.string()),
                _list(order[flat].astype(np.int32), lengths),
            ]
            documents = pa.RecordBatch.from_arrays(lists, [*names, *REPORT, "groups_sha256", "parts"])
            part_links = pa.RecordBatch.from_arrays([_list(place.astype(np.int32), link_counts)], ["places"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([_packed(documents)]), pa.array([_packed(part_links)]), _list(pairs, [len(code)])],
                names=["documents", "part_links", "pairs"])

    return run


def _list(values, lengths: Sequence[int]) -> pa.ListArray:
    values = pa.array(values) if isinstance(values, np.ndarray) else values
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), values)


def _packed(batch: pa.RecordBatch) -> bytes:
    """A batch as compressed bytes: what belongs to a slice moves as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(value: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(value.as_buffer()).read_next_batch()


def _weigh(names: list[str], fields: list[pa.Field]):
    """Documents of each slice with the sums over their links of the pairs' corpus-wide numbers."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for k in range(batch.num_rows):
                documents = _unpacked(batch.column("documents")[k])
                links = _unpacked(batch.column("part_links")[k]).column("places")
                weights = batch.column("weights")[k].values
                of = links.flatten().to_numpy()
                part_of = np.repeat(np.arange(len(links)), links.value_lengths().to_numpy())
                parts = documents.column("parts")
                flat = parts.flatten().to_numpy()
                row_of = np.repeat(np.arange(documents.num_rows), parts.value_lengths().to_numpy())
                # A slice's pairs were numbered in the order of their codes.
                weight = weights.field("weight").to_numpy()[np.argsort(weights.field("code").to_numpy())]
                sums = []
                for value in (weight & 1, weight >> 1):
                    part = _add(part_of, value[of], len(links))
                    sums.append(pa.array(_add(row_of, part[flat], documents.num_rows)))
                columns = [documents.column(n) for n in (*names, *REPORT, "groups_sha256")]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*columns, *sums], fields)], schema=pa.schema(fields))

    return run


def _add(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, groups, values)
    return out


def align_documents(docs: DataFrame, bytes_path: str, pieces_path: str, keys: tuple[str, ...] = ("doc_id",),
                    slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """`keys` of every row with its token, group and link numbers, `groups_sha256`, and over its links `n_best` and `count_sum`."""
    schema = "documents binary, part_links binary, pairs array<struct<code: bigint, n: bigint>>"
    aligned = docs.select(*keys, "text").mapInArrow(_align_slices(bytes_path, pieces_path, slice_bytes, list(keys)), schema)
    held = materialize(aligned.withColumn("slice", F.monotonically_increasing_id()), "aligned")

    said = held.select("slice", F.inline("pairs"))
    totals = said.groupBy("code").agg(F.sum("n").alias("count"))
    # The vocabulary of the other side bounds the pairs of an id.
    highest = F.max("count").over(Window.partitionBy(F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))))
    totals = totals.select("code", (F.col("count") * 2 + (F.col("count") == highest).cast("int")).alias("weight"))
    weighed = said.select("slice", "code").join(totals, "code").groupBy("slice").agg(F.collect_list(F.struct("code", "weight")).alias("weights"))
    rows = held.select("slice", "documents", "part_links").join(weighed, "slice", "left")
    rows = rows.select("documents", "part_links", F.coalesce("weights", F.array().cast("array<struct<code:bigint,weight:bigint>>")).alias("weights"))
    fields = [pa.field(k, to_arrow_type(docs.schema[k].dataType)) for k in keys]
    fields += [pa.field(n, pa.int64()) for n in REPORT]
    fields += [pa.field("groups_sha256", pa.string()), pa.field("n_best", pa.int64()), pa.field("count_sum", pa.int64())]
    out = ", ".join([f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys] + [f"{c} bigint" for c in REPORT])
    return rows.mapInArrow(_weigh(list(keys), fields), out + ", groups_sha256 string, n_best bigint, count_sum bigint")
