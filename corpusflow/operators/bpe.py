"""Byte-level BPE training over the distinct words of a corpus."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.bytelevel import alphabet, base_ids, byte_characters, byte_ids, words_of
from corpusflow.functions.sequences import SPECIAL_TOKENS
from corpusflow.scratch import discard, materialize

Pair = tuple[int, int]
GUIDE_WORDS, GUIDE_WORDS_PER_TOKEN = 50_000, 40  # words that merges are planned from: at least, and for each token wanted
FIRST_BATCH, LARGEST_BATCH = 64, 512
FOLD_AFTER = 256
TOP_PAIRS = 8192  # pair counts that the driver reads for a pass
SLICE_BYTES = 8 << 20  # text that is cut into pieces at once, one row at least


@dataclass(frozen=True)
class Tokenizer:
    """Vocabulary by id and merges `(left, right, merged)` by rank: a few values per vocabulary entry."""

    tokens: tuple[str, ...]
    merges: tuple[tuple[int, int, int], ...]

    @property
    def vocab_size(self) -> int:
        return len(self.tokens)

    def ids_of_bytes(self) -> list[int]:
        """Token id of each byte, wherever the vocabulary has its letter."""
        ids = {t: i for i, t in enumerate(self.tokens)}
        missing = [c for c in byte_characters() if c not in ids]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} byte letters, such as {missing[0]!r}")
        return [ids[c] for c in byte_characters()]

    def special_ids(self) -> dict[str, int]:
        """Ids of the special tokens that the vocabulary has."""
        return {t: i for i, t in enumerate(self.tokens) if t in SPECIAL_TOKENS}

    @staticmethod
    def base() -> "Tokenizer":
        return Tokenizer((*SPECIAL_TOKENS, *alphabet()), ())

    def extended(self, pairs: Iterable[Pair]) -> "Tokenizer":
        grown = _Growing(self)
        for pair in pairs:
            grown.add(pair)
        return grown.tokenizer()


class _Growing:
    """A tokenizer that merges are added to. A merge that spells an existing token reuses its id."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokens, self.merges = list(tokenizer.tokens), list(tokenizer.merges)
        self.known = {t: i for i, t in enumerate(self.tokens)}

    def add(self, pair: Pair) -> int:
        text = self.tokens[pair[0]] + self.tokens[pair[1]]
        if text not in self.known:
            self.known[text] = len(self.tokens)
            self.tokens.append(text)
        self.merges.append((*pair, self.known[text]))
        return self.known[text]

    def tokenizer(self) -> Tokenizer:
        return Tokenizer(tuple(self.tokens), tuple(self.merges))


# Classes of bytes: ASCII letters, ASCII characters that are no blanks, first bytes of longer characters. Blanks may begin with C2, E1, E2 and E3.
_LETTER, _VISIBLE, _TWO, _OPENS = (np.zeros(256, bool) for _ in range(4))
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_VISIBLE[0x21:0x7F] = True
_TWO[0xC3:0xE0] = True
_OPENS[0xE4:0xF5] = True
_OPENS |= _VISIBLE | _TWO


def _cuts(raw: np.ndarray, by_line: bool) -> np.ndarray:
    """Marks places where a word ends whatever surrounds them, and the end of the bytes.

    These are before an ASCII character that is no letter and follows an ASCII letter, before a space between two characters
    that are no blanks, and after a line break. Where other characters leave it open there is no mark: the piece is longer, its
    words are the same.
    """
    edge = np.zeros(len(raw) + 1, bool)
    letter = _LETTER[raw]
    edge[1:-1] = letter[:-1] & ~letter[1:] & (raw[1:] < 0x80)
    spaces = np.flatnonzero(raw == 0x20)
    spaces = spaces[(spaces >= 2) & (spaces < len(raw) - 1)]
    last = raw[spaces - 1]
    edge[spaces[_OPENS[raw[spaces + 1]] & (_VISIBLE[last] | ((last >= 0x80) & _TWO[raw[spaces - 2]]))]] = True
    if by_line:
        edge[1:] |= raw == 0x0A
    edge[-1] = True
    return edge


def _pieces(by_line: bool):
    """Distinct pieces of a slice of texts with their number. Pieces hold whole words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            if not pc.sum(pc.binary_length(texts)).as_py():
                continue
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data, low = np.frombuffer(texts.buffers()[2], np.uint8), 0
            while low < len(texts):
                high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE_BYTES, "right")) - 1)
                raw = data[at[low] : at[high]]
                edge = _cuts(raw, by_line)
                edge[at[low : high + 1] - at[low]] = True
                bounds, low = np.flatnonzero(edge), high
                found = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).value_counts()
                yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["piece", "n"])

    return run


def pretoken_counts(df: DataFrame, by_line: bool = True) -> DataFrame:
    """`(word, cnt)` over all texts; by line, each line counts on its own, with its line break, as if written to a file.

    Texts are cut into pieces that no word crosses, and only the distinct pieces are split into words.
    Both are counted on the map side before their shuffle.
    """
    text = F.concat(F.col("text"), F.lit("\n")) if by_line else F.col("text")
    pieces = df.select(text.alias("text")).filter(F.col("text").isNotNull()).mapInArrow(_pieces(by_line), "piece string, n bigint")
    distinct = pieces.groupBy("piece").agg(F.sum("n").alias("n"))
    return distinct.select(F.explode(words_of(F.col("piece"))).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("cnt"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent base symbols, weighted by the word counts: `(left, right, cnt)`."""
    symbols = words.select(byte_ids(F.col("word")).alias("syms"), "cnt").filter(F.size("syms") > 1)
    pairs = F.zip_with(
        F.slice("syms", F.lit(1), F.size("syms") - 1),
        F.slice("syms", F.lit(2), F.size("syms") - 1),
        lambda a, b: F.struct(a.alias("left"), b.alias("right")),
    )
    return (
        symbols.select(F.explode(pairs).alias("p"), "cnt")
        .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right"))
        .agg(F.sum("cnt").alias("cnt"))
    )


def most_frequent_pairs(pairs: DataFrame, n: int = 1) -> DataFrame:
    """Highest count first, ties by the smaller pair."""
    return pairs.orderBy(F.desc("cnt"), "left", "right").limit(n)


_GONE = -1  # stands where a symbol was merged into the one before it


def segment(word: str, base: list[int], ranks: dict[Pair, tuple[int, int]]) -> list[int]:
    """Token ids of one word: merge the pair of lowest rank, the leftmost first, until none is left.

    Pairs wait in a heap and places know their neighbours, so n bytes take n log n steps.
    """
    ids = [base[b] for b in word.encode()]
    n = len(ids)
    waiting = [(ranks[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
    if not waiting:
        return ids
    heapq.heapify(waiting)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    while waiting:
        rank, i = heapq.heappop(waiting)
        j = right[i]
        found = ranks.get((ids[i], ids[j])) if j < n else None
        if found is None or found[0] != rank:
            continue  # one of the two was merged meanwhile
        ids[i], ids[j] = found[1], _GONE
        right[i] = k = right[j]
        if k < n:
            left[k] = i
        for a, b in ((left[i], i), (i, k)):
            if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                heapq.heappush(waiting, (ranks[ids[a], ids[b]][0], a))
    return [x for x in ids if x != _GONE]


def merge_ranks(tokenizer: Tokenizer) -> dict[Pair, tuple[int, int]]:
    return {(left, right): (rank, merged) for rank, (left, right, merged) in enumerate(tokenizer.merges)}


_END = -1  # stands before the first word and closes every word in the flat form
_MERGED = -2  # where a symbol was merged into the one before it


class _Symbols:
    """Segmented words of one batch as one flat array, with the word's count at every place.

    Places know their neighbours, so a merge costs one scan of the symbols, and the rest by the places it changes.
    """

    def __init__(self, values: np.ndarray, offsets: np.ndarray, counts: np.ndarray):
        lengths = np.diff(offsets)
        self.flat = np.full(1 + len(values) + len(lengths), _END, np.int32)
        inside = np.ones(len(self.flat), bool)
        inside[0] = inside[np.cumsum(lengths + 1)] = False
        self.flat[inside] = values
        self.weight = np.concatenate(([0], np.repeat(counts, lengths + 1)))
        self.before = np.arange(-1, len(self.flat) - 1, dtype=np.int32)
        self.after = np.arange(1, len(self.flat) + 1, dtype=np.int32)

    @staticmethod
    def of_batch(batch: pa.RecordBatch) -> "_Symbols":
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy()[offsets[0]:offsets[-1]]
        return _Symbols(values, offsets, batch.column("cnt").to_numpy())

    def copy(self) -> "_Symbols":
        """The same words, to be merged on their own."""
        other = object.__new__(_Symbols)
        other.flat, other.before, other.after, other.weight = self.flat.copy(), self.before.copy(), self.after.copy(), self.weight
        return other

    def lists(self) -> pa.ListArray:
        flat = self.flat[1:]
        flat = flat[flat != _MERGED]
        inside = flat != _END
        offsets = np.concatenate(([0], np.cumsum(inside)[~inside])).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[inside]))

    def _places(self, pair: Pair) -> np.ndarray:
        """Where `pair` is merged, left to right without overlap."""
        hits = np.flatnonzero(self.flat == pair[0])
        hits = hits[self.flat[self.after[hits]] == pair[1]]
        if pair[0] == pair[1] and len(hits):
            order = np.arange(len(hits))
            fresh = np.concatenate(([True], self.after[hits[:-1]] != hits[1:]))
            run_start = order[fresh][np.cumsum(fresh) - 1]
            hits = hits[(order - run_start) % 2 == 0]
        return hits

    def merge(self, pair: Pair, merged: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merge `pair` in every word; return the pairs whose counts change, and by how much."""
        places = self._places(pair)
        if not len(places):
            return places, places, places
        second = self.after[places]
        before = self._pairs_around(places, second)
        behind = self.after[second]
        self.flat[places], self.flat[second] = merged, _MERGED
        self.after[places], self.before[behind] = behind, places
        after = self._pairs_around(places)
        return _summed(np.concatenate((before[0], after[0])), np.concatenate((-before[1], after[1])))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _summed(*self._pairs_at(np.flatnonzero(self.flat >= 0)))

    def _pairs_around(self, *places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that begin at the places or end at the first of them, each once: two of them may be neighbours."""
        ahead = self.before[places[0]]
        ahead = ahead[np.concatenate(([True], ahead[1:] != places[-1][:-1]))]
        return self._pairs_at(np.concatenate((ahead, *places)))

    def _pairs_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = self.flat[places], self.flat[self.after[places]]
        real = (left != _END) & (right != _END)
        return left[real].astype(np.int64) << 32 | right[real], self.weight[places[real]]


def _summed(codes: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Total per pair, without the pairs that come to nothing."""
    if not len(codes):
        return codes, codes, amounts
    order = np.argsort(codes, kind="stable")
    codes, amounts = codes[order], amounts[order]
    starts = np.flatnonzero(np.concatenate(([True], np.diff(codes) != 0)))
    totals = np.add.reduceat(amounts, starts)
    some = totals != 0
    codes = codes[starts][some]
    return codes >> 32, codes & 0xFFFFFFFF, totals[some]


class _PairQueue:
    """Pair counts with the best pair at hand."""

    def __init__(self, counts: dict[Pair, int]):
        self.counts = counts
        self.heap = [(-c, *p) for p, c in counts.items()]
        heapq.heapify(self.heap)

    def update(self, change: dict[Pair, int]) -> None:
        for pair, delta in change.items():
            if delta:
                count = self.counts.get(pair, 0) + delta
                self.counts[pair] = count
                heapq.heappush(self.heap, (-count, *pair))

    def best(self) -> tuple[Pair, int] | None:
        while self.heap:
            count, left, right = self.heap[0]
            if self.counts.get((left, right)) == -count and count < 0:
                return (left, right), -count
            heapq.heappop(self.heap)
        return None


def _pairs_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = _Symbols.of_batch(batch).pairs()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c.astype(t), t) for c, t in zip(columns, ("int32", "int32", "int64"))], names=["left", "right", "cnt"]
        )


def _replay(pending: list[tuple[int, int, int]], plan: list[tuple[int, int, int]]):
    """Per batch of words: the pair-count changes each planned merge would make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Symbols.of_batch(batch)
            for left, right, merged in pending:
                words.merge((left, right), merged)
            found = [words.merge((left, right), merged) for left, right, merged in plan]
            steps = np.repeat(np.arange(len(plan)), [len(c[0]) for c in found])
            columns = [steps, *(np.concatenate(c) for c in zip(*found))]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, types)],
                names=["step", "left", "right", "delta"],
            )

    return run


def _apply(pending: list[tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Symbols.of_batch(batch)
            for left, right, merged in pending:
                words.merge((left, right), merged)
            yield pa.RecordBatch.from_arrays([words.lists(), batch.column("cnt")], names=["ids", "cnt"])

    return run


def train_bpe(df: DataFrame, vocab_size: int = 5000, min_frequency: int = 2) -> Tokenizer:
    """Merges of the most frequent pair, ties by the smaller pair, up to `vocab_size` tokens."""
    return train_bpe_on_words(pretoken_counts(df), vocab_size, min_frequency)


def train_bpe_on_words(words: DataFrame, vocab_size: int = 5000, min_frequency: int = 2,
                       guide_words: int | None = None, top_pairs: int = TOP_PAIRS) -> Tokenizer:
    """As `train_bpe`, from a `(word, cnt)` table.

    One Spark job per merge would repeat thousands of passes over the words.
    Instead each pass replays a plan of many merges over all words, which gives how
    every merge changes the pair counts. The plan comes from a fixed number of words,
    so it may be wrong but the result may not: merges are taken up to the first one
    that is not the most frequent pair.

    All pair counts stay in a table. The driver holds the `top_pairs` most frequent
    ones and those that the changes of a pass can lift to the last of these. Any other
    pair ranks behind that one, so a merge that does not is the most frequent of all;
    where the best one does, the pass ends and the most frequent are read anew.
    """
    several = words.filter(F.octet_length("word") > 1)
    spelled = materialize(_spread(several.select("word", byte_ids(F.col("word")).alias("ids"), "cnt")), "words")
    guide = _guide(spelled.select("word", "cnt"), guide_words or max(GUIDE_WORDS, GUIDE_WORDS_PER_TOKEN * vocab_size))
    table = spelled.select("ids", "cnt")
    pairs = table.mapInArrow(_pairs_of_words, "left int, right int, cnt bigint")
    counts = materialize(pairs.groupBy("left", "right").agg(F.sum("cnt").alias("cnt")), "pairs")

    tokenizer, folded, size = Tokenizer.base(), 0, FIRST_BATCH
    while tokenizer.vocab_size < vocab_size:
        top = [(r["left"], r["right"], r["cnt"]) for r in most_frequent_pairs(counts, top_pairs).collect()]
        last = top[-1] if len(top) == top_pairs else None
        known = {(left, right): cnt for left, right, cnt in top}
        plan = _plan(tokenizer, known, guide, vocab_size, min_frequency, size)
        if not plan:
            break
        pending = list(tokenizer.merges[folded:])
        if len(pending) >= FOLD_AFTER:
            table = materialize(_spread(table.mapInArrow(_apply(pending), table.schema)), "words")
            folded, pending = len(tokenizer.merges), []
        replayed = table.mapInArrow(_replay(pending, plan), "step int, left int, right int, delta bigint")
        totals = replayed.groupBy("step", "left", "right").agg(F.sum("delta").alias("delta"))
        changes = materialize(totals.filter("delta <> 0"), "changes")
        lifted, steps = _reaching(counts, changes, last, len(plan))
        taken = _held(plan, known | lifted, steps, last, min_frequency)

        before = counts
        made = changes.filter(F.col("step") < len(taken)).select("left", "right", F.col("delta").alias("cnt"))
        now = before.unionByName(made).groupBy("left", "right").agg(F.sum("cnt").alias("cnt")).filter("cnt > 0")
        counts = materialize(now, "pairs")
        discard(before, changes)
        tokenizer = tokenizer.extended(taken)
        for left, right, merged in tokenizer.merges[len(tokenizer.merges) - len(taken):]:
            guide.merge((left, right), merged)
        size = min(size * 2, LARGEST_BATCH) if len(taken) == len(plan) else max(2 * len(taken), FIRST_BATCH)
    return tokenizer


def _reaching(counts: DataFrame, changes: DataFrame, last: tuple[int, int, int] | None,
              steps: int) -> tuple[dict[Pair, int], list[dict[Pair, int]]]:
    """Counts of the pairs that changes may lift as far as `last`, and per step the changes of these and of the pairs up to it."""
    pair = ["left", "right"]
    gains = changes.filter("delta > 0").groupBy(pair).agg(F.sum("delta").alias("gain"))
    grown = gains.join(counts, pair, "left").select(*pair, F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt"), "gain")
    if last is None:
        ahead, wanted = grown, changes
    else:
        left, right, floor = last
        leading = (F.col("cnt") > floor) | ((F.col("cnt") == floor) & (F.struct(*pair) <= F.struct(F.lit(left), F.lit(right))))
        ahead = grown.filter((F.col("cnt") + F.col("gain") >= floor) & ~leading)
        wanted = changes.join(ahead.select(*pair).unionByName(counts.filter(leading).select(*pair)), pair, "left_semi")
    lifted = {(a, b): n for a, b, n in zip(*ahead.select(*pair, "cnt").toArrow().to_pydict().values())}
    found: list[dict[Pair, int]] = [{} for _ in range(steps)]
    for step, a, b, delta in zip(*wanted.select("step", *pair, "delta").toArrow().to_pydict().values()):
        found[step][(a, b)] = delta
    return lifted, found


def _held(plan: list[tuple[int, int, int]], counts: dict[Pair, int], changes: list[dict[Pair, int]],
          last: tuple[int, int, int] | None, min_frequency: int) -> list[Pair]:
    """How far the plan is right: its merges up to the first that is not the best, or that ranks behind `last`."""
    queue = _PairQueue({p: n for p, n in counts.items() if n > 0})
    taken: list[Pair] = []
    for (left, right, _), change in zip(plan, changes):
        best = queue.best()
        if best is None or best[1] < min_frequency or best[0] != (left, right):
            break
        if last is not None and (-best[1], *best[0]) > (-last[2], *last[:2]):
            break
        taken.append(best[0])
        queue.update(change)
    return taken


def _spread(words: DataFrame) -> DataFrame:
    """Merging is work per word, so the table is split by rows and not by bytes."""
    spark = words.sparkSession
    return words.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _guide(words: DataFrame, n: int) -> _Symbols:
    """Words that stand for all: about the `n` most frequent, and `n` of the others by hash, weighted up.

    Both are found by a filter on each row, and both are bounded by `2 * n`.
    """
    total = words.count()
    share = min(n / max(total, 1), 1.0)
    least = words.agg(F.percentile_approx("cnt", 1.0 - share)).first()[0] if share < 1.0 else 0
    top = words.filter(F.col("cnt") > least).limit(2 * n).toArrow()
    parts = [(top, 1.0)]
    rest = total - len(top)
    if rest > 0:
        buckets = 1 << 30
        drawn = F.pmod(F.xxhash64("word"), F.lit(buckets)) < int(buckets * min(n / rest, 1.0))
        sample = words.filter((F.col("cnt") <= least) & drawn).limit(2 * n).toArrow()
        parts.append((sample, rest / max(len(sample), 1)))
    spelled = [word.encode() for part, _ in parts for word in part.column("word").to_pylist()]
    counts = np.concatenate([part.column("cnt").to_numpy() * weight for part, weight in parts])
    values = np.array(base_ids())[np.frombuffer(b"".join(spelled), np.uint8)]
    return _Symbols(values, np.cumsum([0, *map(len, spelled)]), counts)


def _plan(tokenizer: Tokenizer, exact: dict[Pair, int], guide: _Symbols, vocab_size: int, min_frequency: int,
          size: int) -> list[tuple[int, int, int]]:
    """Likely next merges: exact counts now, later changes estimated from the guide words.

    The first of them is exact, so every pass takes at least one merge.
    """
    words = guide.copy()
    queue = _PairQueue(dict(exact))
    grown = _Growing(tokenizer)
    plan: list[tuple[int, int, int]] = []
    while len(plan) < size and len(grown.tokens) < vocab_size:
        top = queue.best()
        if top is None or top[1] < min_frequency:
            break
        pair, count = top
        plan.append((*pair, grown.add(pair)))
        change = {(a, b): d for a, b, d in zip(*(c.tolist() for c in words.merge(pair, plan[-1][2])))}
        seen = -change.pop(pair, 0)
        scale = count / seen if seen > 0 else 0.0
        estimate = {p: round(delta * scale) for p, delta in change.items()}
        estimate[pair] = -queue.counts[pair]
        queue.update(estimate)
    return plan
