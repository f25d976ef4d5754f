import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.bytelevel import words_of
from corpusflow.operators import bpe

MARKS = [*"  \n\r\tabZ19.!'¿«éя夜😀×\x00\x0b\x1c", "'s", "'ll", "\u0085", " ", "́", " ", "᠎", " ", "​", " ", "　", "٣"]


@pytest.mark.parametrize("by_line", [True, False])
def test_counts_equal_those_of_whole_texts(spark, by_line):
    rng = random.Random(3)
    texts = ["".join(rng.choices([" ", " ", *MARKS], k=rng.randint(0, 25))) for _ in range(4000)] + [None, "", " ", "\n", "a b", " a ", "é b  c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    pieces = F.transform(F.split("text", "\n"), lambda t: F.concat(t, F.lit("\n"))) if by_line else F.array("text")
    words = df.select(F.explode(pieces).alias("t")).select(F.explode(words_of(F.col("t"))).alias("word"))
    expected = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}
    assert {r["word"]: r["cnt"] for r in bpe.pretoken_counts(df, by_line).collect()} == expected


@pytest.mark.parametrize("slice_bytes", [1, 40, 1 << 20])
def test_slices_change_nothing(monkeypatch, slice_bytes):
    monkeypatch.setattr(bpe, "SLICE_BYTES", slice_bytes)
    batch = pa.RecordBatch.from_pydict({"text": ["x", "", "one two, one two.\n", "", "one two\nétés là\n", ""]}).slice(1)
    found = {}
    for part in bpe._pieces(True)([batch, batch.slice(0, 0), batch.slice(0, 1)]):
        for piece, n in zip(*part.to_pydict().values()):
            found[piece] = found.get(piece, 0) + n
    assert found == {"one": 2, " two": 3, ",": 1, " one": 1, ".\n": 1, "\n": 1, "étés": 1, " là\n": 1}


def test_a_word_is_split_once_whatever_its_number():
    batch = pa.RecordBatch.from_pydict({"text": ["some words, come again. some words\n" * 500] * 4})
    parts = list(bpe._pieces(True)([batch]))
    assert sum(p.num_rows for p in parts) < 12  # each of these is split by the pattern, not each of 16,000 words
    assert sum(len(piece) * n for p in parts for piece, n in zip(*p.to_pydict().values())) == 4 * 500 * 35


def test_merges_in_a_row_leave_what_a_recount_finds():
    rng = np.random.default_rng(4)
    for _ in range(60):
        lists = [rng.integers(0, 3, rng.integers(0, 12)).tolist() for _ in range(8)]
        counts = rng.integers(1, 5, 8)
        flat = np.array([x for ids in lists for x in ids], np.int64)
        symbols = bpe._Symbols(flat, np.cumsum([0, *map(len, lists)]), counts)
        known = {(a, b): n for a, b, n in zip(*(c.tolist() for c in symbols.pairs()))}
        for merged in range(3, 9):
            untouched, symbols = symbols, symbols.copy()
            kept = untouched.lists().to_pylist()
            pair = tuple(int(x) for x in rng.integers(0, merged, 2))
            for a, b, n in zip(*(c.tolist() for c in symbols.merge(pair, merged))):
                known[a, b] = known.get((a, b), 0) + n
            assert untouched.lists().to_pylist() == kept
            recount = {}
            for ids, count in zip(symbols.lists().to_pylist(), counts.tolist()):
                for p in zip(ids, ids[1:]):
                    recount[p] = recount.get(p, 0) + count
            assert {p: n for p, n in known.items() if n} == recount
            assert not any(p == pair for ids in symbols.lists().to_pylist() for p in zip(ids, ids[1:]) if pair[0] != pair[1])
