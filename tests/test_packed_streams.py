"""Ids that cross shuffles as bytes, texts encoded by their bytes, and digests of windows hashed side by side."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.hashing import slice_digests
from corpusflow.functions.packed import pack, packed_size, unpack
from corpusflow.operators import encode, examples, windows
from corpusflow.operators.bpe import Tokenizer

BASE = Tokenizer.base()
TEXTS = ["ab é " * (i * 7 % 30) for i in range(12)] + [None, "", "[CLS]a[MASK] [MAS", "[SEP][SEP]", "K]", "日本\n\t x's 12"]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string")


@pytest.mark.parametrize("ids", [[], [0], [0, 65_535], [65_536], [-1, 5], [1 << 40], list(range(5000))])
def test_packed_ids_come_back(ids):
    data = pack(np.array(ids, np.int64))
    assert unpack(data).tolist() == ids and packed_size(data) == len(ids)
    if ids == list(range(5000)):
        assert len(data) < 2 * len(ids)


def test_bytes_encode_as_words_do(spark, monkeypatch):
    words = encode.pieces_of(F.coalesce("text", F.lit(""))).alias(encode.WORDS)
    rows = texts(spark).coalesce(1)
    wanted = rows.select("k", words).mapInArrow(encode._encode_words(BASE, "ids"), "k int, ids array<int>").collect()
    assert sorted(encode.encode_ids(rows, BASE).collect()) == sorted(wanted)
    assert "regexp_extract_all" not in encode.encode_ids(rows, BASE)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(encode, "SLICE_BYTES", 7)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array([t or "" for t in TEXTS])], names=["k", encode.WORDS])
    out = list(encode._encode_bytes(BASE, "ids")(iter([batch.slice(3), batch.slice(0, 3)])))
    assert {k: ids for b in out for k, ids in zip(*(c.to_pylist() for c in b.columns))} == {r["k"]: r["ids"] for r in wanted}
    assert len(out) > 9


def test_windows_of_packed_streams(spark, monkeypatch):
    monkeypatch.setattr(windows, "SLICE_TOKENS", 50)
    plain, packed = (windows.encoded_stream(texts(spark), ["k"], BASE, p) for p in (False, True))
    assert dict(packed.dtypes)["ids"] == "binary"
    assert sorted(packed.drop("ids").collect()) == sorted(plain.select(packed.drop("ids").columns).collect())
    assert windows.window_count(packed, 5, 2) == windows.window_count(plain, 5, 2)
    tokens = [t for r in plain.orderBy("k").collect() for t in r["ids"]]
    for length, stride, block in ((3, 1, 8), (4, 2, 1024), (5, 3, 7)):
        wanted = [(s, tokens[s:s + length], tokens[s + 1:s + length + 1]) for s in range(0, len(tokens) - length, stride)]
        for stream in (plain, packed):
            assert sorted(map(tuple, windows.sliding_windows(stream, length, stride, block).collect())) == wanted
        code = lambda ids: hashlib.md5(" ".join(map(str, ids)).encode()).hexdigest()
        rows = windows.sliding_windows(packed, length, stride, block, digests=True).orderBy("block_start").collect()
        assert "".join(r["input_ids"] for r in rows) == "".join(code(i) for _, i, _ in wanted)
        assert "".join(r["labels"] for r in rows) == "".join(code(o) for _, _, o in wanted) and sum(r["windows"] for r in rows) == len(wanted)
        size = block - block % stride
        assert [r["block_start"] for r in rows] == sorted({s // size * size for s, _, _ in wanted})


def test_the_shuffle_of_windows_moves_packed_ids(spark):
    cut = windows.sliding_windows(windows.encoded_stream(texts(spark), ["k"], BASE, True), 16)
    plan = cut._jdf.queryExecution().optimizedPlan().toString().splitlines()
    moved = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert "piece" in plan[moved + 1] and "MapInArrow" in plan[moved + 1]


def test_digests_of_slices(monkeypatch):
    raw = np.random.default_rng(1).integers(0, 256, 700, dtype=np.uint8)
    sizes = np.array([*range(0, 260), 511, 512, 513, 600])
    starts = np.arange(len(sizes)) % 90
    wanted = [hashlib.md5(raw[s:s + n].tobytes()).digest() for s, n in zip(starts, sizes)]
    for lanes in (7, 1 << 14):
        monkeypatch.setattr("corpusflow.functions.hashing.LANES", lanes)
        assert [row.tobytes() for row in slice_digests(raw, starts, sizes)] == wanted
    assert slice_digests(raw, starts[:0], sizes[:0]).shape == (0, 16)


def test_ids_of_padded_batches_cross_no_shuffle(spark):
    rows = [(i, None if i % 5 == 0 else i // 4, "x" * (i * 7 % 23)) for i in range(40)] + [(1, 0, "twice"), (1, 0, "twice")]
    df = spark.createDataFrame(rows, "doc_id int, batch_id int, text string")
    made = examples.masked_lm_inputs(df, BASE, F.col("doc_id"), 0.5)
    longest = {b: max(len(t) for _, c, t in rows if c == b) + 2 for _, b, _ in rows}
    got = made.collect()
    assert len(got) == len(rows) and all(len(r["input_ids"]) == len(r["labels"]) == longest[r["batch_id"]] for r in got)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "Window" not in plan and "MapInArrow" in above and "ArrowEvalPython" in above
