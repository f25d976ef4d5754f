"""Licence notices in texts, by a positional index of the rarest licence words.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case, so
comment marks and punctuation do not move positions. For every template the words of
it that a text has are ranked by their inverse document frequency over all texts; the
KEYS rarest are looked up in the index, whose postings are positions in the template.
A posting and a place in the text give an offset, where the template would begin;
offsets on which NEED postings agree are candidates. A candidate is a notice if its
mandatory phrases stand where the template would, give or take DRIFT, and the text has COVER of the
template's words at their positions, seen from this offset and those up to DRIFT words
on, so that words put into a notice do not hide it.

The document frequencies are counted over all rows, only for the templates' words, so
the driver holds a number per word of the templates. Memory of a task is bounded by
SLICE_BYTES and its longest text. A null or empty text has no words and no notice;
repeated rows and repeated ids are rows of their own, an empty table gives none, and
columns that are not keys or the text are not read. Words of equal frequency rank in
the order of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.words import Ranges, data, offsets, slices

KEYS = 4
NEED = 2
COVER = 0.6
DRIFT = 12


@dataclass(frozen=True)
class Template:
    """A notice as words; `phrases` must stand in it and in a text that has it."""

    label: str
    text: str
    phrases: tuple[str, ...]


# Phrases that count wherever they stand.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Public notices and the words they must have.
TEMPLATES = (
    *(Template(label, phrase, (phrase,)) for phrase, label in PHRASES.items()),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction including without limitation the rights to use "
             "copy modify merge publish distribute sublicense and or sell copies of the software", ("permission is hereby granted free of charge",)),
    Template("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ("apache license version 2 0", "in compliance with the license")),
    Template("apache-2", "spdx license identifier apache 2 0", ("spdx license identifier apache 2 0",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
             "published by the free software foundation either version 2 of the license or at your option any later version",
             ("gnu general public license", "version 2 of the license")),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
             "published by the free software foundation either version 3 of the license or at your option any later version",
             ("gnu general public license", "version 3 of the license")),
    Template("lgpl-2.1", "redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software "
             "foundation either version 2 1 of the license", ("gnu lesser general public license", "version 2 1 of the license")),
    Template("lgpl-3", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license version 3",)),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license version 3",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("bsd-2", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
             "conditions are met", ("redistribution and use in source and binary forms",)),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission", ("endorse or promote products derived from this software",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("distribute this software for any purpose",)),
    Template("cc-by-4", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
             ("creative commons attribution noncommercial 4 0 international",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
             ("waived all copyright and related or neighboring rights",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("free and unencumbered software released into the public domain",)),
)

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

Batches = Iterator[pa.RecordBatch]


class _Index:
    """Templates as arrays of word numbers; numbers follow the order of the words' bytes."""

    def __init__(self, templates: Sequence[Template], phrases: dict[str, str]):
        texts = [*phrases, *(t.text for t in templates), *(p for t in templates for p in t.phrases)]
        self.words = sorted({w for text in texts for w in text.split()}, key=str.encode)
        number = {w: i for i, w in enumerate(self.words)}
        ids = lambda text: np.array([number[w] for w in text.split()], np.int64)
        self.templates = [(t.label, ids(t.text), [ids(p) for p in t.phrases]) for t in templates]
        self.base = [(label, ids(phrase)) for phrase, label in phrases.items()]
        self.needed = [np.unique(np.concatenate(ps)) for _, _, ps in self.templates]
        spelled = [np.frombuffer(w.encode(), np.uint8) for w in self.words]
        self.sizes = np.array([len(s) for s in spelled])
        self.letters = np.zeros((len(spelled), self.sizes.max()), np.uint8)
        for i, s in enumerate(spelled):
            self.letters[i, : len(s)] = s
        at = np.concatenate(([0], np.cumsum(self.sizes)))
        hashes = Ranges(np.concatenate(spelled)).hash(at[:-1], at[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word of all texts, -1 for words of no template, and where the words of each text begin."""
        at, raw = offsets(texts), data(texts)
        if not len(raw):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        inside = _WORD[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[at] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        lower = _LOWER[raw]
        found = np.searchsorted(self.hashes, hashes := Ranges(lower).hash(starts, ends))
        found[found == len(self.hashes)] = 0
        ids = np.where(self.hashes[found] == hashes, self.order[found], -1)
        for size in np.unique(self.sizes):  # equal hashes are confirmed letter by letter
            hits = np.flatnonzero(ids >= 0)
            hits = hits[self.sizes[ids[hits]] == size]
            same = ends[hits] - starts[hits] == size
            same[same] = (lower[starts[hits[same]][:, None] + np.arange(size)] == self.letters[ids[hits[same]], :size]).all(1)
            ids[hits[~same]] = -1
        return ids, np.searchsorted(starts, at)


def _row_of(begins: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(begins) - 1), np.diff(begins))


def _has(ids: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """Which rows have which words."""
    table = np.zeros((len(begins) - 1, n), bool)
    known = np.flatnonzero(ids >= 0)
    table[_row_of(begins)[known], ids[known]] = True
    return table


def _document_counts(index: _Index):
    def run(batches: Batches) -> Batches:
        rows, total = 0, np.zeros(len(index.words), np.int64)
        for batch in slices(batches):
            rows += batch.num_rows
            total += _has(*index.numbers(batch.column("text")), len(index.words)).sum(0)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["word", "documents"])

    return run


def document_counts(docs: DataFrame, index: _Index) -> np.ndarray:
    """In how many rows each word of the templates stands."""
    parts = docs.select("text").mapInArrow(_document_counts(index), "word int, documents bigint")
    counts = np.zeros(len(index.words), np.int64)
    for row in parts.groupBy("word").agg(F.sum("documents").alias("documents")).collect():  # a row per word of the templates
        counts[row["word"]] = row["documents"]
    return counts


def _runs(ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of `phrase` stand consecutively."""
    n = len(ids) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(ids[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[ids[at + k] == phrase[k]]
    return at


def _notices(ids: np.ndarray, words: np.ndarray, phrases: list[np.ndarray], keys: np.ndarray) -> list[tuple[int, float]]:
    """Offsets and coverage of the verified places of a template in a text."""
    votes = [np.flatnonzero(ids == words[t]) - t for t in np.flatnonzero(np.isin(words, keys))]
    offset, count = np.unique(np.concatenate(votes), return_counts=True) if votes else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    offset = offset[count >= min(NEED, len(words))]
    for phrase in phrases:
        at = _runs(ids, phrase)
        offset = offset[np.searchsorted(at, offset - DRIFT, "left") < np.searchsorted(at, offset + len(words) + DRIFT, "left")]
    if not len(offset):
        return []
    place = offset[:, None] + np.arange(len(words))
    inside = (place >= 0) & (place < len(ids))
    same = inside & (ids[np.where(inside, place, 0)] == words)
    seen = same.copy()
    for k in range(1, min(DRIFT, len(offset) - 1) + 1):
        near = np.flatnonzero(offset[k:] - offset[:-k] <= DRIFT)
        seen[near] |= same[near + k]
    cover = seen.sum(1) / len(words)
    return [(int(o), float(c)) for o, c in zip(offset, cover) if c >= COVER]


BASE = "array<struct<label: string, start: bigint>>"
NOTICES = "array<struct<label: string, template: int, start: bigint, coverage: double>>"


def _scan(index: _Index, rarest: np.ndarray, names: list[str]):
    """`rarest`: the rank of each word, the least frequent first."""
    base_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    notice_type = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()), ("coverage", pa.float64())]))

    def run(batches: Batches) -> Batches:
        for batch in slices(batches):
            ids, begins = index.numbers(batch.column("text"))
            row_of = _row_of(begins)
            base: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            notices: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for label, phrase in index.base:
                at = _runs(ids, phrase)
                at = at[row_of[at] == row_of[at + len(phrase) - 1]]
                for row, start in zip(row_of[at].tolist(), (at - begins[row_of[at]]).tolist()):
                    base[row].append({"label": label, "start": start})
            has = _has(ids, begins, len(index.words))
            for number, (label, words, phrases) in enumerate(index.templates):
                distinct = np.unique(words)
                distinct = distinct[np.argsort(rarest[distinct])]
                # A text without all words of the phrases can't have them.
                for row in np.flatnonzero(has[:, index.needed[number]].all(1)).tolist():
                    keys = distinct[has[row, distinct]][:KEYS]
                    for start, cover in _notices(ids[begins[row] : begins[row + 1]], words, phrases, keys):
                        notices[row].append({"label": label, "template": number, "start": start, "coverage": cover})
            columns = [batch.column(n) for n in names]
            columns += [pa.array(np.diff(begins)), pa.array(base, base_type), pa.array(notices, notice_type)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "base", "notices"])

    return run


def scan_licenses(docs: DataFrame, keys: Sequence[str] = ("doc_id",), templates: Sequence[Template] = TEMPLATES,
                  phrases: dict[str, str] | None = None) -> DataFrame:
    """`keys` of every row with `n_words`, the places of the base phrases and the verified notices."""
    index = _Index(templates, PHRASES if phrases is None else phrases)
    counts = document_counts(docs, index)
    rarest = np.empty(len(counts), np.int64)
    rarest[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    own = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, "text").mapInArrow(_scan(index, rarest, list(keys)), f"{own}, n_words bigint, base {BASE}, notices {NOTICES}")
