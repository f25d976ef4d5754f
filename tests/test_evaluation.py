import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.hashing import digest, uniform_from
from corpusflow.operators import evaluation

SCHEMA = "id int, logits array<float>, label int"


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    logits = np.round(rng.normal(size=(60, 12)), 1).astype(np.float32)  # rounding makes ties
    labels = [int(x) if i % 7 else -100 for i, x in enumerate(rng.integers(0, 12, 60))]
    return logits, labels


def frame(spark, table):
    return spark.createDataFrame([(i, x.tolist(), y) for i, (x, y) in enumerate(zip(*table))], SCHEMA)


def order(row):
    return sorted(range(len(row)), key=lambda i: (-row[i], i))


def nll(row, label):
    row = row.astype(float)
    return math.log(np.exp(row - row.max()).sum()) + row.max() - row[label]


def test_accuracy_and_losses(spark, table):
    logits, labels = table
    valid = [(x, y) for x, y in zip(logits, labels) if y != -100]
    df = frame(spark, table)
    metrics = evaluation.token_level_metrics(df).first()
    top1 = np.mean([order(x)[0] == y for x, y in valid])
    assert metrics["accuracy"] == pytest.approx(top1) and evaluation.accuracy(df).first()[0] == pytest.approx(top1)
    assert metrics["top5_accuracy"] == pytest.approx(np.mean([y in order(x)[:5] for x, y in valid]))
    losses = [nll(x, y) for x, y in valid]
    assert evaluation.cross_entropy(df).first()[0] == pytest.approx(np.mean(losses))
    batches = {}
    for i, (x, y) in enumerate(zip(logits, labels)):
        if y != -100:
            batches.setdefault(i // 7, []).append(nll(x, y))
    row = evaluation.validation_loss(df.withColumn("batch_id", F.floor(F.col("id") / 7))).first()
    mean = np.mean([np.mean(b) for b in batches.values()])
    assert row["loss"] == pytest.approx(mean) and row["perplexity"] == pytest.approx(math.exp(mean))
    got = {r["predicted"] == order(logits[r["id"]])[0] for r in evaluation.with_predictions(df).collect()}
    assert got == {True}
    assert all(r["top_indices"] == order(logits[r["id"]])[:5] for r in evaluation.with_top_indices(df).collect())


def test_no_valid_label_gives_null(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], -100)], SCHEMA)
    assert evaluation.accuracy(df).first()[0] is None
    assert list(evaluation.token_level_metrics(df).first()) == [None, None]
    assert evaluation.cross_entropy(df).first()[0] is None


def test_argmax_ties_take_the_lowest_index(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0, 5.0], 1)], SCHEMA)
    assert evaluation.with_predictions(df).first()["predicted"] == 1


def allowed(row, temperature, top_k, top_p):
    x = row.astype(float) / temperature
    ranked = order(x)
    if top_k is not None:
        kth = x[ranked[min(top_k, len(x)) - 1]]
        ranked = [i for i in ranked if x[i] >= kth]
    p = np.exp(x[ranked] - x[ranked[0]])
    p /= p.sum()
    if top_p is not None:
        keep = [j for j in range(len(p)) if j == 0 or p[:j].sum() <= top_p]
        ranked, p = [ranked[j] for j in keep], p[keep] / p[keep].sum()
    return ranked, p


@pytest.mark.parametrize("temperature,top_k,top_p", [(1.0, None, None), (0.7, 4, None), (1.3, None, 0.6), (0.5, 6, 0.5), (1.0, 50, 0.0)])
def test_sampling(spark, table, temperature, top_k, top_p):
    df = frame(spark, table)
    uniforms = {r[0]: r[1] for r in df.select("id", uniform_from(digest(9, F.col("id")))).collect()}
    kept = {r["id"]: r["candidates"] for r in evaluation.with_nucleus(df, top_p, temperature, top_k).collect()}
    drawn = {r["id"]: r["next_token"] for r in evaluation.sample_next_token(df, F.col("id"), temperature, top_k, top_p, 9).collect()}
    for i, row in enumerate(table[0]):
        ids, p = allowed(row, temperature, top_k, top_p)
        assert [c["idx"] for c in kept[i]] == ids
        assert [c["p"] for c in kept[i]] == pytest.approx(list(p))
        assert drawn[i] == ids[min(int((np.cumsum(p) <= uniforms[i]).sum()), len(ids) - 1)]


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([(0, [1.0, 3.0, 2.0, 2.0], 1)], SCHEMA)
    assert evaluation.with_top_k(df, 2).first()["logits"] == [None, 3.0, 2.0, 2.0]


def test_generated_text(spark):
    df = spark.createDataFrame([("a b a c",), ("",)], "text string")
    rows = evaluation.generation_diversity(df, F.filter(F.split("text", " "), lambda t: t != "")).collect()
    assert [(r["n_tokens"], r["diversity"], r["n_chars"]) for r in rows] == [(4, 0.75, 7), (0, None, 0)]
    values = spark.createDataFrame([(0.04, 1), (0.05, 12), (0.11, 25), (None, 3)], "diversity double, n_tokens int")
    assert {r["bucket"]: r["n"] for r in evaluation.histogram(values, "diversity", 0.05).collect()} == {0: 1, 1: 1, 2: 1}
    assert evaluation.length_correlation(values).first()[0] == pytest.approx(np.corrcoef([1, 12, 25], [0.04, 0.05, 0.11])[0, 1])
    buckets = {r["bucket"]: r["n"] for r in evaluation.diversity_by_length(values, 10).collect()}
    assert buckets == {0: 2, 1: 1, 2: 1}
