"""Interpolated modified Kneser-Ney bigram model over whole corpora.

Training makes two passes. The first counts words; the distinct word hashes are
written as sorted arrays, and a word's id is its place in them. The second counts
word pairs. Tasks aggregate their tokens into sorted blocks of (key, count), one for
each shard, and only these blocks are shuffled: a word that makes up a third of the
corpus is one entry of a block. A shard task merges its blocks and writes plain
little-endian arrays to the shared folder. Scoring tasks memory-map those files.

Every file is written under a name of its own by the attempt that made it, and only
files named by finished tasks (the manifest) are read, so a lost executor or a
repeated task changes nothing.

The model: the context of a token is the token before it, of the first one the end
token. With c the count of a pair, n(h) what follows h,
    p(w|h) = max(c(h,w) - D(c), 0) / c(h) + gamma(h) * p1(w)
    p1(w)  = max(k(w) - D1(k), 0) / K + gamma1 / (V + 1)
where k(w) is the number of different words before w and K their sum. The discounts
for counts 1, 2 and more come from the counts of counts. Words outside the training
texts share one class. A null text is empty and has the end token alone; without
training texts every token has probability 1.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.words import mix, slices, word_hashes
from corpusflow.scratch import materialize, scratch_path

END = np.uint64(0x454E44)  # the hash of the end token
FLUSH_TOKENS = 4_000_000  # tokens a task holds before it aggregates them
SHARD_TOKENS = 8_000_000  # tokens for which a shard is planned

Batches = Iterator[pa.RecordBatch]


# Files -----------------------------------------------------------------------


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write(folder: str, name: str, array: np.ndarray) -> str:
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    store, local = _store(path)
    store.create_dir(os.path.dirname(local), recursive=True)
    with store.open_output_stream(local) as out:
        out.write(memoryview(np.ascontiguousarray(array)).cast("B") if array.size else b"")
    return path


def _map(path: str, kind: type) -> np.ndarray:
    """A memory-mapped array. A file in a remote store is copied to a local one that has no name any more."""
    store, local = _store(path)
    size = store.get_file_info(local).size
    if not size:
        return np.zeros(0, kind)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(local, kind, "r")
    with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(local) as source:
        while piece := source.read(8 << 20):
            copy.write(piece)
        copy.flush()
        return np.memmap(copy.name, kind, "r")


# Blocks ----------------------------------------------------------------------

BLOCK = "shard int, keys binary, counts binary"


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts, first) if len(first) else counts)


def _blocks(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order].astype(np.int64), shard[order]
    names, at = np.unique(shard, return_index=True)
    bounds = np.r_[at, len(shard)]
    rows = [(keys[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int32()), pa.array([k for k, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.binary())],
        names=["shard", "keys", "counts"],
    )


def _merged(batches: Batches) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The blocks of each shard of a task merged; keys are distinct and in order."""
    held: dict[int, list[tuple[bytes, bytes]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["shard"], []).append((row["keys"], row["counts"]))
    for shard in sorted(held):
        parts = held.pop(shard)
        keys = np.frombuffer(b"".join(k for k, _ in parts), np.uint64)
        counts = np.frombuffer(b"".join(c for _, c in parts), np.int64)
        del parts
        yield shard, *_summed(keys, counts)


def _sharded(blocks: DataFrame, shards: int, reduce: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """One task for each shard."""
    return blocks.repartition(shards, "shard").mapInArrow(reduce, schema)


# Model -----------------------------------------------------------------------


@dataclass
class Model:
    """Where the arrays lie, and the numbers that are the same for all texts."""

    shards: int = 1
    tokens: int = 0
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # first word id of each shard
    words: list[str] = field(default_factory=list)  # hashes of the words, by shard
    counts: list[str] = field(default_factory=list)
    before: list[str] = field(default_factory=list)  # k(w), by word id
    contexts: dict[int, tuple[str, str, str]] = field(default_factory=dict)  # by shard of pairs: id, c(h), n1..n3
    pairs: dict[int, tuple[str, str]] = field(default_factory=dict)
    discount: tuple[float, float, float] = (0.0, 0.0, 0.0)
    discount1: tuple[float, float, float] = (0.0, 0.0, 0.0)
    total_before: int = 0
    gamma1: float = 1.0

    @property
    def vocabulary(self) -> int:
        return int(self.first[-1])


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts n1, n2, n3, n4; each within 0 and its count."""
    if not n[0]:
        return 0.0, 0.0, 0.0
    y = n[0] / (n[0] + 2 * n[1])
    found = [1 - 2 * y * n[1] / n[0]]
    for k in (2, 3):
        found.append(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else found[-1])
    return tuple(float(min(max(d, 0.0), k)) for k, d in enumerate(found, 1))


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    taken = np.select([counts <= 0, counts == 1, counts == 2], [0.0, d[0], d[1]], d[2])
    return np.maximum(counts - taken, 0.0)


def _shard_of_word(words: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, in order."""
    return ((words >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def _shard_of_id(ids: np.ndarray, shards: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def _with_ends(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each text followed by the end token, and where each text begins."""
    return np.insert(words, at[1:], END), at + np.arange(len(at))


def _count_words(shards: int):
    def run(batches: Batches) -> Batches:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys, counts = _summed(np.concatenate(held))
            held.clear()
            return _blocks(keys, counts, _shard_of_word(keys, shards))

        for batch in slices(batches):
            tokens, _ = _with_ends(*word_hashes(batch.column("text")))
            held.append(tokens)
            size += len(tokens)
            if size >= FLUSH_TOKENS:
                yield flush()
                size = 0
        if held:
            yield flush()

    return run


class _Lookup:
    """Word ids from the memory-mapped, sorted word hashes."""

    def __init__(self, model: Model):
        self.model = model
        self.words = [_map(p, np.uint64) for p in model.words]

    def ids(self, words: np.ndarray) -> np.ndarray:
        """Ids of words given in order of their hashes; -1 where unknown."""
        out = np.full(len(words), -1, np.int64)
        shards = self.model.shards
        bounds = np.searchsorted(_shard_of_word(words, shards), np.arange(shards + 1))
        for s in range(shards):
            part, known = words[bounds[s] : bounds[s + 1]], self.words[s]
            if not len(part) or not len(known):
                continue
            place = np.minimum(np.searchsorted(known, part), len(known) - 1)
            out[bounds[s] : bounds[s + 1]] = np.where(known[place] == part, place + self.model.first[s], -1)
        return out


def _count_pairs(model: Model, shards: int):
    def run(batches: Batches) -> Batches:
        lookup = _Lookup(model)
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys, counts = _summed(np.concatenate(held))
            held.clear()
            return _blocks(keys, counts, _shard_of_id(keys >> np.uint64(32), shards))

        for batch in slices(batches):
            tokens, at = _with_ends(*word_hashes(batch.column("text")))
            distinct, place = np.unique(tokens, return_inverse=True)
            ids = lookup.ids(distinct)
            end = ids[np.searchsorted(distinct, END)]
            ids = ids[place]
            context = np.r_[end, ids[:-1]]
            context[at[:-1]] = end
            held.append(context.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64))
            size += len(ids)
            if size >= FLUSH_TOKENS:
                yield flush()
                size = 0
        if held:
            yield flush()

    return run


FILES = "shard int, files array<string>, n bigint, total bigint, ones bigint, twos bigint, threes bigint, fours bigint"


def _entry(shard: int, files: list[str], counts: np.ndarray) -> dict:
    ones, twos, threes, fours = (int((counts == k).sum()) for k in (1, 2, 3, 4))
    return {"shard": shard, "files": files, "n": len(counts), "total": int(counts.sum()), "ones": ones, "twos": twos, "threes": threes, "fours": fours}


def _schema_of(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("shard", pa.int32()), ("files", pa.list_(pa.string())), *((k, pa.int64()) for k in ("n", "total", "ones", "twos", "threes", "fours"))]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def _write_words(folder: str):
    def run(batches: Batches) -> Batches:
        for shard, keys, counts in _merged(batches):
            files = [_write(folder, f"words-{shard}", keys), _write(folder, f"counts-{shard}", counts)]
            yield _schema_of([_entry(shard, files, counts)])

    return run


PAIRS = FILES + ", target int, keys binary, counts binary"


def _write_pairs(folder: str, model: Model):
    """Pairs of a shard, statistics of their contexts, and for every word how many contexts it follows here."""
    first = model.first

    def run(batches: Batches) -> Batches:
        for shard, keys, counts in _merged(batches):
            context = keys >> np.uint64(32)
            at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            kinds = np.stack([np.add.reduceat(x.astype(np.int64), at) for x in (counts == 1, counts == 2, counts > 2)], 1)
            files = [
                _write(folder, f"pairs-{shard}", keys), _write(folder, f"pair-counts-{shard}", counts.astype(np.uint32)),
                _write(folder, f"contexts-{shard}", context[at].astype(np.int64)),
                _write(folder, f"totals-{shard}", np.add.reduceat(counts, at)), _write(folder, f"kinds-{shard}", kinds),
            ]
            head = _entry(shard, files, counts)
            words, n = _summed(keys & np.uint64(0xFFFFFFFF))
            blocks = _blocks(words, n, (np.searchsorted(first, words.astype(np.int64), "right") - 1).astype(np.int32))
            rows = [{**head, "target": None, "keys": None, "counts": None}]
            empty = {**{k: None for k in head}}
            rows += [{**empty, "target": r["shard"], "keys": r["keys"], "counts": r["counts"]} for r in blocks.to_pylist()]
            kinds_ = [("shard", pa.int32()), ("files", pa.list_(pa.string())), *((k, pa.int64()) for k in ("n", "total", "ones", "twos", "threes", "fours")), ("target", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds_))

    return run


def _write_before(folder: str, first: np.ndarray):
    def run(batches: Batches) -> Batches:
        for shard, ids, counts in _merged(batches):
            dense = np.zeros(first[shard + 1] - first[shard], np.int64)
            dense[ids.astype(np.int64) - first[shard]] = counts
            yield _schema_of([_entry(shard, [_write(folder, f"before-{shard}", dense)], counts)])

    return run


def train(texts: DataFrame, shards: int | None = None) -> Model:
    """Model of the `text` column of all rows.

    The driver receives a row for each shard, which holds millions of tokens: file
    names and sums, never words or pairs.
    """
    folder = scratch_path(texts.sparkSession, "lm")
    texts = texts.select("text")
    planned = shards or max(4, texts.sparkSession.sparkContext.defaultParallelism)
    if shards is None:
        size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
        planned = max(planned, int(size) // (6 * SHARD_TOKENS) + 1)
    words = materialize(_sharded(texts.mapInArrow(_count_words(planned), BLOCK), planned, _write_words(folder), FILES), "lm-words")
    entries = {r["shard"]: r for r in words.collect()}
    if not entries:
        return Model()
    sizes = [entries[s]["n"] if s in entries else 0 for s in range(planned)]
    nothing = _write(folder, "empty", np.zeros(0, np.int64))
    model = Model(
        shards=planned, tokens=sum(r["total"] for r in entries.values()), first=np.concatenate(([0], np.cumsum(sizes))),
        words=[entries[s]["files"][0] if s in entries else nothing for s in range(planned)],
        counts=[entries[s]["files"][1] if s in entries else nothing for s in range(planned)],
    )
    counted = texts.mapInArrow(_count_pairs(model, planned), BLOCK)
    pairs = materialize(_sharded(counted, planned, _write_pairs(folder, model), PAIRS), "lm-pairs")
    manifest = pairs.filter("shard IS NOT NULL").drop("target", "keys", "counts").collect()
    model.pairs = {r["shard"]: tuple(r["files"][:2]) for r in manifest}
    model.contexts = {r["shard"]: tuple(r["files"][2:]) for r in manifest}
    model.discount = discounts([sum(r[k] for r in manifest) for k in ("ones", "twos", "threes", "fours")])

    blocks = pairs.filter("target IS NOT NULL").select(F.col("target").alias("shard"), "keys", "counts")
    before = materialize(_sharded(blocks, planned, _write_before(folder, model.first), FILES), "lm-before")
    found = {r["shard"]: r for r in before.collect()}
    model.before = [found[s]["files"][0] if s in found else nothing for s in range(planned)]
    n = [sum(r[k] for r in found.values()) for k in ("ones", "twos", "threes", "fours")]
    model.discount1 = discounts(n)
    model.total_before = sum(r["total"] for r in found.values())
    more = sum(r["n"] for r in found.values()) - n[0] - n[1]
    taken = sum(d * k for d, k in zip(model.discount1, (n[0], n[1], more)))
    model.gamma1 = taken / model.total_before if model.total_before else 1.0
    return model


SCORES = "n_tokens bigint, n_known bigint, base_score double, score double"


class _Scorer(_Lookup):
    def __init__(self, model: Model):
        super().__init__(model)
        self.counts = [_map(p, np.int64) for p in model.counts]
        self.before = [_map(p, np.int64) for p in model.before]
        self.pairs = {s: (_map(k, np.uint64), _map(c, np.uint32)) for s, (k, c) in model.pairs.items()}
        self.contexts = {s: (_map(i, np.int64), _map(t, np.int64), _map(k, np.int64).reshape(-1, 3)) for s, (i, t, k) in model.contexts.items()}

    def _dense(self, arrays: list[np.ndarray], ids: np.ndarray) -> np.ndarray:
        """Values of ids in order; 0 for -1."""
        out = np.zeros(len(ids), np.int64)
        first = self.model.first
        bounds = np.searchsorted(ids, first)
        for s in range(self.model.shards):
            if bounds[s] < bounds[s + 1] and len(arrays[s]):
                out[bounds[s] : bounds[s + 1]] = arrays[s][ids[bounds[s] : bounds[s + 1]] - first[s]]
        return out

    def _context(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """c(h) and gamma(h) of distinct contexts; 0 and 1 where the context is unknown."""
        total, gamma = np.zeros(len(ids)), np.ones(len(ids))
        shard = _shard_of_id(ids, self.model.shards)
        for s, (known, totals, kinds) in self.contexts.items():
            rows = np.flatnonzero((shard == s) & (ids >= 0))
            if not len(rows):
                continue
            place = np.minimum(np.searchsorted(known, ids[rows]), len(known) - 1)
            hit = known[place] == ids[rows]
            rows, place = rows[hit], place[hit]
            total[rows] = totals[place]
            gamma[rows] = kinds[place] @ np.array(self.model.discount) / totals[place]
        return total, gamma

    def _pair_counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        shard = _shard_of_id(keys >> np.uint64(32), self.model.shards)
        for s, (known, counts) in self.pairs.items():
            rows = np.flatnonzero(shard == s)
            if len(rows):
                place = np.minimum(np.searchsorted(known, keys[rows]), len(known) - 1)
                out[rows] = np.where(known[place] == keys[rows], counts[place], 0)
        return out

    def score(self, texts: pa.Array) -> list[np.ndarray]:
        model = self.model
        tokens, at = _with_ends(*word_hashes(texts))
        distinct, place = np.unique(tokens, return_inverse=True)
        ids = self.ids(distinct) if model.words else np.full(len(distinct), -1, np.int64)
        order = np.argsort(ids, kind="stable")
        count, before = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        if model.words:
            count[order] = self._dense(self.counts, ids[order])
            before[order] = self._dense(self.before, ids[order])
        base = np.log10((count + 1) / (model.tokens + model.vocabulary + 1))
        lower = _discounted(before, model.discount1) / max(model.total_before, 1) + model.gamma1 / (model.vocabulary + 1)
        total, gamma = self._context(ids)

        end = int(np.searchsorted(distinct, END))
        context = np.r_[end, place[:-1]]
        context[at[:-1]] = end
        key = ids[context].astype(np.uint64) << np.uint64(32) | (ids[place].astype(np.uint64) & np.uint64(0xFFFFFFFF))
        key[(ids[context] < 0) | (ids[place] < 0)] = np.uint64(0xFFFFFFFFFFFFFFFF)
        keys, back = np.unique(key, return_inverse=True)
        pair = self._pair_counts(keys)[back]
        seen = total[context]
        high = np.divide(_discounted(pair, model.discount), seen, out=np.zeros(len(pair)), where=seen > 0)
        p = np.log10(high + gamma[context] * lower[place])
        sums = [np.add.reduceat(x, at[:-1]) for x in ((count > 0)[place].astype(np.int64), base[place], p)]
        return [np.diff(at), *sums]


def score(df: DataFrame, model: Model) -> DataFrame:
    """Rows of `df` with `n_tokens`, `n_known`, `base_score` and `score` of their `text`; the text is left out."""
    kept = [f for f in df.schema.fields if f.name != "text"]
    names = [f.name for f in kept]

    def run(batches: Batches) -> Batches:
        scorer = _Scorer(model)
        for batch in slices(batches):
            n, known, base, p = scorer.score(batch.column("text"))
            columns = [*(batch.column(c) for c in names), pa.array(n), pa.array(known), pa.array(base), pa.array(p)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_tokens", "n_known", "base_score", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), SCORES])
    return df.select(*names, "text").mapInArrow(run, schema)


def perplexity(score: Column, tokens: Column) -> Column:
    return F.pow(F.lit(10.0), -score / tokens)
