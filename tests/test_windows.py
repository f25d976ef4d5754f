import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions.permutation import permuted
from corpusflow.operators import bpe, windows
from corpusflow.plans.corpus import make_training_batches


def stream_of(spark, lengths):
    total, rows = 0, []
    for i, n in enumerate(lengths):
        rows.append((i, list(range(total, total + n))))
        total += n
    df = spark.createDataFrame(rows, "doc int, ids array<int>")
    return df, total


def check(spark, lengths, length, stride, block):
    df, total = stream_of(spark, lengths)
    stream = windows.document_token_offsets(df, ["doc"])
    cut = windows.sliding_windows(stream, length, stride, block)
    got = sorted((r["window_start"], r["input_ids"], r["labels"]) for r in cut.collect())
    tokens = list(range(total))
    assert got == [(s, tokens[s:s + length], tokens[s + 1:s + length + 1]) for s in range(0, max(0, total - length), stride)]


@pytest.mark.parametrize(
    "lengths,length,stride,block",
    [
        ([3], 5, 1, 8), ([5], 5, 1, 8), ([6], 5, 1, 8), ([0, 0], 2, 1, 4), ([10, 0, 7, 40], 4, 1, 8),
        ([8, 8, 8], 8, 1, 8), ([100], 7, 7, 20), ([33, 1, 1, 50], 4, 4, 4), ([30], 10, 3, 7), ([16, 1], 16, 1, 16),
        ([40], 20, 1, 6),
    ],
)
def test_windows(spark, lengths, length, stride, block):
    check(spark, lengths, length, stride, block)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 30), min_size=1, max_size=8), st.integers(1, 12), st.integers(1, 12), st.integers(1, 25))
def test_windows_like_slices(spark, lengths, length, stride, block):
    check(spark, lengths, length, stride, block)


def test_offsets_and_stream(spark):
    df, total = stream_of(spark, [4, 0, 3, 1])
    stream = windows.document_token_offsets(df, ["doc"])
    assert [(r["doc"], r["start_pos"], r["n_tokens"]) for r in stream.orderBy("doc").collect()] == [(0, 0, 4), (1, 4, 0), (2, 4, 3), (3, 7, 1)]
    tokens = windows.token_stream(stream, ["doc"]).orderBy("pos").collect()
    assert [(r["pos"], r["token_id"]) for r in tokens] == [(i, i) for i in range(total)]


def test_batches(spark):
    df = spark.range(10).select("id", (F.col("id") * 7 % 10).alias("key"))
    rows = windows.assign_batches(df, ["key"], 4, drop_last=True).orderBy("batch_id", "slot").collect()
    assert [(r["key"], r["batch_id"], r["slot"]) for r in rows] == [(i, i // 4, i % 4) for i in range(8)]
    assert windows.assign_batches(df, ["key"], 4, drop_last=False).count() == 10
    assert windows.loader_length(df, 4, True).first()[0] == 2 and windows.loader_length(df, 4, False).first()[0] == 3


def test_training_batches(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(30)], "id int, text string")
    base = bpe.Tokenizer.base()
    order = lambda **o: [
        (r["batch_id"], r["slot"], r["window_start"])
        for r in make_training_batches(df, ["id"], base, 8, 4, **o).orderBy("batch_id", "slot").collect()
    ]
    first, again, other = order(seed=1), order(seed=1), order(seed=1, epoch=1)
    assert first == again and first != other and len(first) % 4 == 0
    assert [r[:2] for r in first] == [(i // 4, i % 4) for i in range(len(first))]
    starts = [r[2] for r in order(training=False)]
    assert starts == list(range(len(starts))) and set(r[2] for r in first) <= set(starts)
    assert len(starts) - len(first) < 4


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 10007])
def test_permutations_are_bijections_that_depend_on_the_key(spark, n):
    rows = spark.range(n)
    orders = [
        [r[0] for r in rows.select(permuted(F.col("id"), n, seed, epoch)).collect()] for seed, epoch in ((0, 0), (0, 1), (1, 0))
    ]
    assert all(sorted(o) == list(range(n)) for o in orders)
    if n >= 64:
        assert orders[0] != orders[1] != orders[2]
        far = np.abs(np.array(orders[0]) - np.arange(n))
        assert n / 4 < far.mean() < n / 2  # a third of n for a random order
        steps = np.abs(np.diff(orders[0]))
        assert n / 4 < steps.mean() < n / 2 and len(set(steps.tolist())) > n / 3


def test_large_ranges_stay_in_range(spark):
    n = 2**61 - 1
    places = spark.createDataFrame([(0,), (1,), (n // 2,), (n - 1,)], "id bigint").select(permuted(F.col("id"), n)).collect()
    assert len({r[0] for r in places}) == 4 and all(0 <= r[0] < n for r in places)


def test_permuted_batches_hold_every_window_once_and_are_not_sorted(spark):
    df = spark.createDataFrame([(i, "x" * (i * 7 % 50)) for i in range(100)], "id int, text string")
    stream = windows.encoded_stream(df, ["id"], bpe.Tokenizer.base())
    cut = windows.sliding_windows(stream, 8, 3)
    count = windows.window_count(stream, 8, 3)
    assert count == cut.count()
    placed = windows.place_batches(cut, count, 3, 16, (4, 0))
    rows = placed.select("batch_id", "slot", "window_start").collect()
    assert sorted(r["batch_id"] * 16 + r["slot"] for r in rows) == list(range(count // 16 * 16))
    assert len({r["window_start"] for r in rows}) == count // 16 * 16
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert windows.window_count(stream.limit(0), 8, 3) == 0
