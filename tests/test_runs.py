import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import runs


def log(spark, rows):
    return spark.createDataFrame(rows, "name string, step bigint, value double")


UPDATES = [("loss", 0, 4.0), ("loss", 1, 3.6), ("accuracy", 0, 0.75), ("accuracy", 1, 0.78)]


def test_metric_tracker(spark):
    table = log(spark, UPDATES)
    assert {r["name"]: r["average"] for r in runs.metric_averages(table).collect()} == {"loss": 3.8, "accuracy": 0.765}
    assert runs.metric_average(table, "loss").first()[0] == 3.8
    assert runs.metric_average(table, "none").first()[0] is None
    assert runs.metric_latest(table, ["step"], "loss").first()[0] == 3.6
    assert runs.metric_latest(table, ["step"], "none").first()[0] is None
    assert {r["name"]: r["latest"] for r in runs.metric_current(table, ["step"]).collect()} == {"loss": 3.6, "accuracy": 0.78}
    assert runs.metric_current_wide(table, ["step"], ["loss", "accuracy"]).first().asDict() == {"loss": 3.6, "accuracy": 0.78}


def test_moving_average(spark, monkeypatch):
    monkeypatch.setattr(runs, "BLOCK_ROWS", 16)
    values = [("hot", i, float(i * 7 % 31)) for i in range(200)] + [("rare", i, float(i)) for i in range(3)]
    table = log(spark, values).repartition(5)
    for window in (1, 5, 20):
        last = {r["name"]: r["moving_average"] for r in runs.moving_average(table, ["step"], window).collect()}
        series = {(r["name"], r["step"]): r["moving_average"] for r in runs.moving_average_series(table, ["step"], window).collect()}
        assert len(series) == 203
        for name in ("hot", "rare"):
            seen = [v for n, _, v in values if n == name]
            for i in range(len(seen)):
                part = seen[max(0, i - window + 1): i + 1]
                assert series[name, i] == pytest.approx(sum(part) / len(part))
            assert last[name] == pytest.approx(series[name, len(seen) - 1])


def fold(losses, patience, min_delta):
    best, counter, stop, out = None, 0, False, []
    for loss in losses:
        score = -loss
        if best is None:
            best = score
        elif score < best + min_delta:
            counter += 1
            stop = stop or counter >= patience
        else:
            best, counter = score, 0
        out.append((counter, stop))
    return out


@pytest.mark.parametrize("patience,min_delta", [(2, 0.01), (3, 0.0), (4, 0.3), (2, -0.2)])
def test_early_stopping(spark, patience, min_delta):
    rng = random.Random(patience)
    cases = {
        1: [2.5, 2.52, 2.55],
        2: [1.0, 1.0, 1.0, 1.0],
        3: [3.0, 3.1, 3.2, 3.3, 1.0, 0.9],
        4: [5 - 0.1 * i for i in range(40)],
        5: [rng.random() for _ in range(300)],
        6: [1.0],
    }
    rows = [(run, i, loss) for run, losses in cases.items() for i, loss in enumerate(losses)]
    table = spark.createDataFrame(rows, "run int, step bigint, loss double").repartition(4)
    got = {(r["run"], r["step"]): (r["counter"], r["early_stop"]) for r in runs.early_stopping(table, "run", ["step"], "loss", patience, min_delta).collect()}
    assert got == {(run, i): x for run, losses in cases.items() for i, x in enumerate(fold(losses, patience, min_delta))}
    summary = {r["run"]: r for r in runs.early_stopping_summary(table, "run", "step", "loss", patience, min_delta).collect()}
    for run, losses in cases.items():
        stops = [i for i, (_, s) in enumerate(fold(losses, patience, min_delta)) if s]
        assert (summary[run]["stopped"], summary[run]["stop_step"]) == (bool(stops), stops[0] if stops else None)


LONG = {
    "steady": lambda r, i: 100 - 0.01 * i,
    "noisy": lambda r, i: 50 / (1 + 0.01 * i) + r.random(),
    "rising": lambda r, i: 0.001 * i,
    "saw": lambda r, i: 10 - 0.002 * i + i % 7,
    "holes": lambda r, i: float("nan") if i % 97 == 5 else float("inf") if i % 101 == 7 else -0.0 if i % 50 == 3 else r.random(),
    "ties": lambda r, i: float(5 - i // 400 + i % 2),
}


@pytest.mark.parametrize("min_delta", [0.0, 0.05, 1.0, -0.1])
def test_long_runs_over_many_ranges_equal_a_fold(spark, min_delta):
    rng = random.Random(9)
    cases = {name: [f(rng, i) for i in range(1500)] for name, f in LONG.items()} | {f"s{k}": [rng.random() for _ in range(k)] for k in range(1, 60)}
    cases[None] = [rng.random() for _ in range(700)]
    rows = [(run, i, loss) for run, losses in cases.items() for i, loss in enumerate(losses)]
    table = spark.createDataFrame(rows, "run string, step bigint, loss double").repartition(4)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(keep, ("37", "false")):
            spark.conf.set(k, v)
        stops = runs.early_stopping(table, "run", ["step"], "loss", 6, min_delta).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    got = {(r["run"], r["step"]): (r["counter"], r["early_stop"]) for r in stops}
    assert got == {(run, i): x for run, losses in cases.items() for i, x in enumerate(fold(losses, 6, min_delta))}
    assert {(r["run"], r["step"]): str(abs(r["loss"])) for r in stops} == {(run, i): str(abs(x)) for run, i, x in rows}


def test_rows_without_a_loss_are_no_checks(spark):
    losses = [None, 2.0, None, 2.5, 2.6, None, 1.0, None]
    table = spark.createDataFrame([(1, i, v) for i, v in enumerate(losses)] + [(2, 0, None)], "run int, step bigint, loss double")
    stops = runs.early_stopping(table, "run", ["step"], "loss", 2, 0.1).orderBy("run", "step").collect()
    assert [(r["counter"], r["early_stop"]) for r in stops] == [
        (0, False), (0, False), (0, False), (1, False), (2, True), (2, True), (0, True), (0, True), (0, False)]
    assert runs.early_stopping(table.limit(0), "run", ["step"], "loss").count() == 0


def test_two_losses_without_improvement_stop(spark):
    table = spark.createDataFrame([(1, i, v) for i, v in enumerate([2.5, 2.52, 2.55])], "run int, step bigint, loss double")
    stops = runs.early_stopping(table, "run", ["step"], "loss", 2, 0.01).orderBy("step").collect()
    assert [r["early_stop"] for r in stops] == [False, False, True]


def test_best_so_far(spark):
    table = spark.createDataFrame([(1, i, v) for i, v in enumerate([3.0, 3.0, 2.0, 2.5])], "run int, step bigint, loss double")
    rows = runs.best_so_far(table, "run", ["step"], "loss").orderBy("step").collect()
    assert [(r["best_before"], r["is_best"]) for r in rows] == [(None, True), (3.0, False), (3.0, True), (2.0, False)]


def test_checkpoints(spark):
    rows = [("a", s, f"a{s}", v) for s, v in ((0, 3.0), (100, 1.0), (200, None), (300, 1.0))] + [("b", 0, "b0", None)]
    table = spark.createDataFrame(rows, "run_id string, step bigint, path string, val_loss double")
    kept = runs.checkpoint_retention(table, max_checkpoints=2)
    assert sorted(r["path"] for r in kept.collect()) == ["a200", "a300", "b0"]
    choose = lambda **o: {r["run_id"]: r["path"] for r in runs.resolve_checkpoint(table, **o).collect()}
    assert choose(load_best=True) == {"a": "a100", "b": "b0"}
    assert choose(load_latest=True) == choose() == {"a": "a300", "b": "b0"}
    assert choose(explicit="x", load_best=True) == {"a": "x", "b": "x"}
    assert sorted(r["step"] for r in runs.cadence_filter(table, 200).filter("run_id = 'a'").collect()) == [0, 200]


def test_throughput(spark):
    rows = [("r", 100, 0.5, 10.0), ("r", 300, 1.5, 30.0), ("z", 5, 0.0, 1.0)]
    steps = spark.createDataFrame(rows, "run_id string, tokens bigint, seconds double, mem_mb double")
    total = {r["run_id"]: r for r in runs.throughput_summary(steps).collect()}
    assert (total["r"]["total_tokens"], total["r"]["total_time"], total["r"]["tokens_per_sec"], total["r"]["max_memory_mb"]) == (400, 2.0, 200.0, 30.0)
    assert total["z"]["tokens_per_sec"] == 0.0
    assert [r["tokens_per_sec"] for r in runs.step_throughput(steps).orderBy("tokens").collect()] == [None, 200.0, 200.0]
    epoch = {r["run_id"]: r for r in runs.epoch_estimate(runs.throughput_summary(steps), 4, 8, 10).collect()}
    assert (epoch["r"]["tokens_per_epoch"], epoch["r"]["seconds_per_epoch"], epoch["z"]["seconds_per_epoch"]) == (320, 1.6, None)
    losses = spark.createDataFrame([(0, 2.0), (0, 4.0), (1, 1.0)], "epoch int, loss double")
    assert {r["epoch"]: r["epoch_loss"] for r in runs.epoch_loss(losses).collect()} == {0: 3.0, 1: 1.0}


def test_an_epoch_may_have_over_two_to_the_31_tokens(spark):
    steps = spark.createDataFrame([("r", 100, 0.5, 1.0)], "run_id string, tokens bigint, seconds double, mem_mb double")
    for n, batches in ((1 << 21, 1 << 21), (1 << 21, F.lit(1 << 21)), (1 << 40, 1 << 40)):
        row = runs.epoch_estimate(runs.throughput_summary(steps), 16, 128, batches).first()
        assert (row["tokens_per_epoch"], row["seconds_per_epoch"]) == (2048 * n, 2048 * n / 200.0)


def test_newest_rows_beyond_the_rank_limit(spark):
    rows = [("hot", i, float(i)) for i in range(3000)] + [("rare", i, float(i)) for i in range(5)]
    table = log(spark, rows).repartition(4)
    for window in (1000, 2000):
        last = {r["name"]: r["moving_average"] for r in runs.moving_average(table, ["step"], window).collect()}
        assert last == {"hot": sum(range(3000 - window, 3000)) / window, "rare": 2.0}
