import random
import zlib

import numpy as np
import pytest

from corpusflow.llm import packing

pytest.importorskip("public_tokenizers")
from corpusflow.llm.queries import tokenizer_path  # noqa: E402

ODD = [None, "", "  \n ", "a b\x1cc", "It's don't we'll 'sword' été, É. ÀB! 3.5a, (x)", "İ ẞ H̱a ſ. K. ŉ, 中文。abc,", "<|endoftext|>x a<|startoftext|>.", "x" * 5000]


def test_tokens_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(5)
    noise = "".join(chr(rng.choice([*range(32, 0x250), *range(0x300, 0x400)])) for _ in range(5000))
    texts = [t or "" for t in ODD] + [noise]
    for text, ids in zip(texts, packing.tokenize(texts, tokenizer_path())):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def test_latin_letters_and_marks_are_tokenized_alike_one_by_one():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    letters = [chr(c) for c in range(0x21, 0x300)]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    texts = [*(x + m for x in letters for m in ("", "a", "e.", "\u0301")), *("ab" + a + b for a in marks for b in marks), *("É" + a + "s" for a in marks)]
    encoder = packing._Encoder(tokenizer_path())
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_pieces_and_packing(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    texts = ODD + ["word " * n for n in (10, 30, 60, 90, 100, 130, 5)] + [ODD[4]]
    df = spark.createDataFrame([(None if i == 3 else i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, length string")
    rows = packing.pack_documents(df, tokenizer_path(), capacity=100).toPandas()
    wanted = []
    for i, t in enumerate(texts):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 100):
            part = np.array(ids[k : k + 100], "<u4")
            wanted.append((-1 if i == 3 else i, k // 100, k, len(part), zlib.crc32(part.tobytes())))
    found = rows.fillna({"doc_id": -1})[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(int)
    assert sorted(map(tuple, found.values.tolist())) == sorted(wanted)
    for _, sequence in rows.sort_values("offset").groupby("sequence_id"):
        assert sequence["offset"].tolist() == [0, *sequence["length"].cumsum().tolist()[:-1]]
        assert sequence["length"].sum() <= 100
    assert rows["sequence_id"].nunique() == packing.lower_bound(rows["length"].to_numpy(), 100)


def test_packing_over_many_partitions_and_an_empty_table(spark):
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1000, 3000)
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "id bigint, length bigint")
    rows = packing.pack(df, 1000, items=400).toPandas()
    assert len(rows) == 3000 and rows.groupby("sequence_id")["length"].sum().max() <= 1000
    assert rows["sequence_id"].nunique() <= 1.02 * packing.lower_bound(lengths, 1000)  # partitions of 400 pieces are small
    assert packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_the_bound_never_exceeds_the_optimum(seed):
    rng = np.random.default_rng(seed)
    bins = [rng.multinomial(30, np.ones(k) / k) for k in rng.integers(1, 6, 8)]
    lengths = np.concatenate(bins)
    lengths = lengths[lengths > 0]
    bound = packing.lower_bound(lengths, 30)
    sequence, _ = packing.best_fit_decreasing(lengths, 30)
    assert -(-lengths.sum() // 30) <= bound <= 8 <= sequence.max() + 1


def test_the_bound_sees_pieces_that_do_not_fit_together():
    assert packing.lower_bound(np.array([51] * 10), 100) == 10
    assert packing.lower_bound(np.array([34] * 9), 100) == 5
    assert packing.lower_bound(np.array([], int), 100) == 0
