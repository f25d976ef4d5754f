"""Work on ids in bounded pieces, and the forms of examples and windows that never build padded or repeated arrays."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusflow.functions.hashing import digest, position_digests, uniform_from
from corpusflow.functions.logits import let
from corpusflow.functions.permutation import permuted
from corpusflow.functions.sequences import MASK, count_of, is_special, mask_tokens
from corpusflow.operators import encode, examples, ordering, windows
from corpusflow.operators.bpe import Tokenizer
from corpusflow.plans.corpus import make_training_batches

BASE = Tokenizer.base()


def test_encoding_yields_bounded_batches(monkeypatch):
    monkeypatch.setattr(encode, "SLICE_WORDS", 5)
    rows = [["a"] * 3, [], ["b"] * 9, ["c"], ["d", "e"], []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.string()))], names=["n", encode.WORDS])
    out = list(encode._encode_words(BASE, "ids")(iter([batch.slice(1), batch.slice(0, 1)])))
    found = {n: ids for b in out for n, ids in zip(b.column("n").to_pylist(), b.column("ids").to_pylist())}
    assert found == {n: [BASE.tokens.index(w) for w in words] for n, words in enumerate(rows)}
    assert all(sum(map(len, b.column("ids").to_pylist())) <= 5 or len(b) <= 2 for b in out) and len(out) > 2


def test_running_sums_send_only_weights_to_python(spark):
    rows = spark.createDataFrame([(i, i % 7, "x" * 50) for i in range(500)], "k int, w int, wide string")
    placed = ordering.ordered_layout(rows.repartition(5), ["k"], weight="w")
    got = [(r["k"], r["start"], r["position"]) for r in placed.orderBy("k").collect()]
    assert got == [(i, sum(j % 7 for j in range(i)), i) for i in range(500)]


def test_position_digests_equal_md5():
    prefixes = ["3|7|", "3|", "é|" * 9, "x" * 60]
    for some in (prefixes[:3], prefixes):
        rows = np.array([i % len(some) for i in range(40)])
        places = np.array([10 ** (i % 8) - i % 2 for i in range(40)])
        wanted = [hashlib.md5(f"{some[r]}{p}".encode()).hexdigest() for r, p in zip(rows, places)]
        got = position_digests(some, rows, places)
        assert ["".join(f"{x:08x}" for x in column) for column in got.T.tolist()] == wanted
    assert position_digests([], np.array([], int), np.array([], int)).shape == (4, 0)


def test_masking_draws_as_before(spark, monkeypatch):
    texts = [(1, [0, 1, 3, 2, *range(4, 90)]), (None, list(range(20))), (3, []), (4, [1, 0, 3]), (5, None), (1234567, [7] * 1200)]
    df = spark.createDataFrame(texts, "k bigint, ids array<int>")

    def replace(token, position):
        def drawn(code):
            other = F.floor(uniform_from(code, 3) * 260).cast("int")
            changed = F.when(uniform_from(code, 1) < 0.8, F.lit(MASK)).when(uniform_from(code, 2) < 0.5, other).otherwise(token)
            return F.when(uniform_from(code, 0) < 0.4, changed).otherwise(token)

        return F.when(is_special(token), token).otherwise(let(digest(9, F.col("k"), position), drawn))

    got = df.select("k", mask_tokens(F.col("ids"), F.col("k"), 260, 0.4, 9).alias("got"), F.transform("ids", replace).alias("wanted")).collect()
    assert [r["got"] for r in got] == [r["wanted"] for r in got]


def test_text_of_batches_equals_their_arrays(spark):
    rows = [(1, 1, "a b"), (2, 1, "longer text here"), (3, 2, ""), (4, 2, None), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id int, batch_id int, text string")
    for make in (
        lambda **o: examples.prepare_inputs(df, BASE, **o),
        lambda **o: examples.causal_lm_inputs(df, BASE, -100, **o),
        lambda **o: examples.masked_lm_inputs(df, BASE, F.col("doc_id"), 0.5, **o),
        lambda **o: examples.masked_lm_inputs(df, BASE, F.col("doc_id"), 0.5, only_changed=True, **o),
    ):
        for options in ({}, {"max_length": 3}, {"max_length": 0}, {"max_length": 30, "truncation": False}, {"padding": False}):
            arrays, texts = make(**options), make(text=True, **options)
            for c in arrays.columns[2:]:
                wanted = {str(r[0]): " ".join(map(str, r[1])) for r in arrays.select("doc_id", c).collect()}
                assert {str(r[0]): r[1] for r in texts.select("doc_id", c).collect()} == wanted, (c, options)


def test_labels_before_padding_equal_labels_of_padded_rows(spark):
    df = spark.createDataFrame([(1, 1, "a b"), (2, 1, "longer text"), (3, 2, "")], "doc_id int, batch_id int, text string")
    inputs = examples.prepare_inputs(df, BASE)
    causal = examples.with_causal_labels(inputs, -1)
    masked = examples.with_masked_labels(inputs, F.col("doc_id"), BASE.vocab_size, 0.5, 4, True)
    pairs = [(examples.causal_lm_inputs(df, BASE, -1), causal), (examples.masked_lm_inputs(df, BASE, F.col("doc_id"), 0.5, 4, True), masked)]
    for now, before in pairs:
        assert sorted(map(str, now.select(before.columns).collect())) == sorted(map(str, before.collect()))


def test_windows_as_text_equal_windows(spark):
    texts = spark.createDataFrame([(i, "ab é " * (i * 7 % 30)) for i in range(12)], "k int, text string")
    stream = windows.encoded_stream(texts, ["k"], BASE)
    for length, stride, block in ((3, 1, 8), (4, 2, 1024), (5, 3, 7)):
        wanted = {r[0]: (" ".join(map(str, r[1])), " ".join(map(str, r[2]))) for r in windows.sliding_windows(stream, length, stride, block).collect()}
        rows = windows.sliding_windows(stream, length, stride, block, text=True).select(F.inline("windows")).collect()
        assert {r[0]: (bytes(r[1]).decode(), bytes(r[2]).decode()) for r in rows} == wanted and len(rows) == len(wanted) > 0


def test_training_batches_keep_int_ids_and_shifted_labels(spark):
    texts = spark.createDataFrame([(i, "ab é " * (i * 7 % 30)) for i in range(12)], "k int, text string")
    for sort in (True, False):
        batches = make_training_batches(texts, ["k"], BASE, 8, 4, 2, seed=1, sort=sort)
        assert dict(batches.dtypes)["input_ids"] == dict(batches.dtypes)["labels"] == "array<int>"
        wanted = {r[0]: (r[1], r[2]) for r in windows.sliding_windows(windows.encoded_stream(texts, ["k"], BASE), 8, 2).collect()}
        rows = batches.collect()
        assert rows and all((r["input_ids"], r["labels"]) == wanted[r["window_start"]] for r in rows)


def test_places_are_drawn_above_the_cut_of_windows(spark):
    texts = spark.createDataFrame([(i, "ab é " * 20) for i in range(12)], "k int, text string")
    cut = windows.sliding_windows(windows.encoded_stream(texts, ["k"], BASE), 8, 2, joined=True)
    placed = windows.place_batches(cut, 400, 2, 4, (0, 0))
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.index("Filter") < plan.index("ArrowEvalPython") < plan.index("slice(tokens")


def test_count_of(spark):
    df = spark.createDataFrame([([2, 3, 2],), ([],), ([1],)], "ids array<int>")
    assert [r[0] for r in df.select(count_of(F.col("ids"), 2)).collect()] == [2, 0, 0]
