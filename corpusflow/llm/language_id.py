"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram binds the vectors of
its letters, each rotated by its place, by multiplication; a text bundles its
trigrams by addition, and a language is the bundle of all its training texts. A text
belongs to the language whose prototype has the largest cosine with its own vector.

Prototypes are sums, so each task adds up its texts and passes on one vector for
each language. Prototypes are the only thing that goes to all tasks: languages times
DIMENSIONS numbers.

Letters are what Unicode calls letters, lower-cased; everything else separates words,
and one separator stands at each edge of a word. A text without letters, or null, is
`und` with score 0. Ties go to the first language in alphabetical order. Without
training texts every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.words import mix, slices

DIMENSIONS = 1024
UNKNOWN = "und"
KEPT_TRIGRAMS = 50_000  # trigram vectors a task remembers

_U = np.uint64
Batches = Iterator[pa.RecordBatch]


def _letter_table() -> np.ndarray:
    """For the code points of the basic plane: the letter itself, or 0."""
    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x10000)), np.uint32, 0x10000)


_LETTERS = _letter_table()


def letters(text: str) -> np.ndarray:
    """Lower-cased letters of the text, with a single 0 between words and at both ends; empty without letters."""
    lower = text.lower()
    points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _LETTERS[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        found[i] = points[i] if lower[i].isalpha() else 0
    if not found.any():
        return np.zeros(0, np.uint32)
    found = np.concatenate(([0], found, [0])).astype(np.uint32)
    return found[(found != 0) | np.r_[True, found[:-1] != 0]]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of the text as numbers, and how often each occurs."""
    found = letters(text).astype(np.uint64)
    if len(found) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.unique(found[:-2] << _U(42) | found[1:-1] << _U(21) | found[2:], return_counts=True)


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """Random signs for each letter, drawn from the code point alone."""
    words = np.arange(dimensions // 64, dtype=np.uint64)
    drawn = mix(points.astype(np.uint64)[:, None] * _U(0x9E3779B97F4A7C15) + words[None, :] + _U(1))
    bits = (drawn[:, :, None] >> np.arange(64, dtype=np.uint64)) & _U(1)
    return bits.reshape(len(points), -1).astype(np.int8) * 2 - 1


def trigram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    parts = [grams >> _U(42), grams >> _U(21) & _U(0x1FFFFF), grams & _U(0x1FFFFF)]
    one, two, three = (letter_vectors(p, dimensions) for p in parts)
    return np.roll(one, 2, axis=1) * np.roll(two, 1, axis=1) * three


class _Vectors:
    """Trigram vectors by number; forgets all when there are too many."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.clear()

    def clear(self) -> None:
        self.grams = np.zeros(0, np.uint64)
        self.rows = np.zeros(0, np.int64)
        self.table = np.zeros((0, self.dimensions), np.float32)

    def place(self, grams: np.ndarray) -> np.ndarray:
        """Rows of distinct, ordered trigrams in `table`."""
        at = np.searchsorted(self.grams, grams)
        known = np.zeros(len(grams), bool)
        inside = at < len(self.grams)
        known[inside] = self.grams[at[inside]] == grams[inside]
        if not known.all():
            new = grams[~known]
            if len(self.grams) + len(new) > KEPT_TRIGRAMS and len(self.grams):
                self.clear()
                return self.place(grams)
            rows = np.arange(len(self.table), len(self.table) + len(new))
            self.table = np.concatenate([self.table, trigram_vectors(new, self.dimensions).astype(np.float32)])
            order = np.argsort(np.concatenate([self.grams, new]), kind="stable")
            self.rows = np.concatenate([self.rows, rows])[order]
            self.grams = np.concatenate([self.grams, new])[order]
            at = np.searchsorted(self.grams, grams)
        return self.rows[at]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dimensions, np.float64)
        for a in range(0, len(grams), KEPT_TRIGRAMS // 4):
            rows = self.place(grams[a : a + KEPT_TRIGRAMS // 4])
            out += counts[a : a + KEPT_TRIGRAMS // 4].astype(np.float32) @ self.table[rows]
        return out


def _add_up(dimensions: int):
    def run(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        vectors = _Vectors(dimensions)
        for batch in slices(batches):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang is not None and text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                found, counts = trigrams(" ".join(texts))
                if len(found):
                    sums[lang] = sums.get(lang, 0) + vectors.bundle(found, counts)
        rows = [(lang, v.tolist()) for lang, v in sums.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
                names=["lang", "vector"])

    return run


def train(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages in `labelled(text, lang)`; a row for each language comes to the driver."""
    sums = labelled.filter("lang IS NOT NULL").select("text", "lang").mapInArrow(_add_up(dimensions), "lang string, vector array<double>")
    total = sums.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("col"))
    rows = total.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "col"))).alias("v")).select("lang", "v.col").collect()
    found = {r["lang"]: np.array(r["col"]) for r in sorted(rows, key=lambda r: r["lang"])}
    return {k: v / n for k, v in found.items() if (n := float(np.linalg.norm(v))) > 0}


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """Rows of `df` with `lang_pred` and `score`, the cosine cut to 0 to 1; the text is left out."""
    kept = [f for f in df.schema.fields if f.name != "text"]
    names = [f.name for f in kept]
    langs = sorted(prototypes)
    matrix = np.stack([prototypes[k] for k in langs]) if langs else np.zeros((0, dimensions))

    def run(batches: Batches) -> Batches:
        vectors = _Vectors(dimensions)
        for batch in slices(batches):
            found, scores = [], []
            for text in batch.column("text").to_pylist():
                grams, counts = trigrams(text) if text and langs else ((), ())
                if not len(grams):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = vectors.bundle(grams, counts)
                cosine = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-12)
                best = int(np.argmax(cosine))
                found.append(langs[best])
                scores.append(float(min(max(cosine[best], 0.0), 1.0)))
            columns = [*(batch.column(c) for c in names), pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "lang_pred", "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double"])
    return df.select(*names, "text").mapInArrow(run, schema)
