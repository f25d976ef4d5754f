"""Token alignment against whole texts tokenized and compared token by token."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import alignment

pytest.importorskip("public_tokenizers")
from corpusflow.llm.queries import BYTES_TOKENIZER, PIECES_TOKENIZER, tokenizer_path  # noqa: E402

ODD = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b\n\nc", "x▁y z", "tab\tq \n r", "é 中文\r\nz  k <s> </s> <unk> <0x41> <|endoftext|>",
    "the the the", "don't 's \n's n't", "a\x1cb c\x85d e", "\U0001f600 \U0001f600‍ x", "\x00 \x01", "x" * 3000, "ab " * 5000, "a b 　c",
    "a  b", "é ö ﬁ ①", "12345 67,8.9 --==",
]


def _paths():
    return tokenizer_path(BYTES_TOKENIZER), tokenizer_path(PIECES_TOKENIZER)


def _places(ids, spelled):
    at = 0
    for i in ids:
        yield at, at + len(spelled[i]), i
        at += len(spelled[i])


def plain(texts):
    """Whole texts through both tokenizers; ranges compared by their ends."""
    pair = alignment.Pair(*_paths())
    rows, counts = [], Counter()
    for text in texts:
        if not text:
            rows.append(None)
            continue
        whole = (" " + text).encode()
        a = list(_places(pair.a.encode(" " + text, add_special_tokens=False).ids, pair.a_bytes))
        b = list(_places(pair.b.encode(text), pair.b_bytes))
        if any(b"".join(s[i] for *_, i in side) != whole for side, s in ((a, pair.a_bytes), (b, pair.b_bytes))):
            rows.append(None)
            continue
        links, begin = [], 0
        for low, high, i in a:
            while b[begin][1] <= low:
                begin += 1
            k = begin
            while k < len(b) and b[k][0] < high:
                links.append((i, b[k][2]))
                k += 1
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        sides = [[[] for _ in ends], [[] for _ in ends]]
        for side, tokens in zip(sides, (a, b)):
            for _, high, i in tokens:
                side[bisect.bisect_left(ends, high)].append(str(i))
        spelled = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides))
        rows.append((len(a), len(b), len(ends), links, hashlib.sha256(spelled.encode()).hexdigest()))
        counts.update(links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (0, 0, 0, 0, "", 0, 0) if r is None else
        (*r[:3], len(r[3]), r[4], sum(counts[x] == best[x[1]] for x in r[3]), sum(counts[x] for x in r[3])) for r in rows
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("size", [alignment.SLICE_BYTES, 200])
def test_odd_texts_and_small_slices(spark, size):
    rng = random.Random(4)
    alphabet = ["a", "the", ",", "; ", " ", "  ", "\n", "\n\n", "\t", "é", "中", "'s", "ing", "X", "9", ".", "\r", " ", "\x1f", "😀"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(300)] + [ODD[7]] * 5
    docs = spark.createDataFrame([(None if i % 50 == 0 else i // 2, t, i, "clash") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, no int, pairs string")
    docs = docs.repartition(7)
    found = alignment.align_documents(docs, *_paths(), keys=("doc_id", "no"), slice_bytes=size).orderBy("no").collect()
    assert [r["doc_id"] for r in found] == [None if i % 50 == 0 else i // 2 for i in range(len(texts))]
    wanted = plain(texts)
    assert [tuple(r[c] for c in COLUMNS) for r in found] == wanted
    assert sum(w[0] == 0 for w in wanted) >= 3


def test_an_empty_table_and_the_table_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert alignment.align_documents(docs.limit(0), *_paths()).count() == 0
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    found = alignment.align_documents(docs, *_paths()).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == plain([r["text"] for r in rows])


def test_groups_and_links_of_sizes():
    def aligned(a, b):
        ends, a_stop, b_stop, *links = alignment.align(np.array(a), np.array(b))
        return ends.tolist(), a_stop.tolist(), b_stop.tolist(), list(zip(*(x.tolist() for x in links)))

    assert aligned([2, 1, 3, 1], [3, 1, 2, 1]) == ([3, 6, 7], [2, 3, 4], [1, 3, 4], [(0, 0), (1, 0), (2, 1), (2, 2), (3, 3)])
    assert aligned([1, 2, 1], [2, 2]) == ([4], [3], [2], [(0, 0), (1, 0), (1, 1), (2, 1)])


def test_forgetting_parts_changes_nothing(spark, monkeypatch):
    texts = [f"word{i % 9} and w{i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    held = alignment._Parts(alignment.Pair(*_paths()))
    held.numbered(alignment.cut(texts[0]))
    held.clear()
    assert held.numbered(alignment.cut(texts[1])).tolist() == [0, 1, 2]
    monkeypatch.setattr(alignment, "PARTS", 3)
    found = alignment.align_documents(docs, *_paths(), slice_bytes=50).agg(F.sum("count_sum"), F.sum("n_links")).first()
    wanted = plain(texts)
    assert tuple(found) == (sum(w[6] for w in wanted), sum(w[3] for w in wanted))
