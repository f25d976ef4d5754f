import random

import pytest

from corpusflow.sources.run_catalog import resolve_from_catalog
from corpusflow.sources.writers import catalog_summary
from corpusflow.streaming import catalog

SCHEMA = "run_id string, step bigint, path string, val_loss double"


def state(spark, folder):
    rows = catalog.read_catalog(spark, folder).collect()
    return sorted(tuple(r) for r in rows), sorted(tuple(r) for r in catalog.read_evicted(spark, folder).collect())


def batches(seed, size=60):
    rng = random.Random(seed)
    rows = [(rng.choice("aab"), i, f"p{i}", rng.choice([None, rng.random(), 0.5])) for i in range(size)]
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(size), 3))
    return rows, [rows[i:j] for i, j in zip([0, *cuts], [*cuts, size])]


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_give_the_catalog_of_all_rows(spark, tmp_path, seed):
    folder = str(tmp_path / "c")
    rows, parts = batches(seed)
    upsert = catalog.upsert_checkpoints(folder, 3)
    for number, part in enumerate(parts):
        upsert(spark.createDataFrame(part, SCHEMA), number)
    whole = catalog_summary(spark.createDataFrame(rows, SCHEMA), 3).collect()
    got, gone = state(spark, folder)
    columns = ("run_id", "checkpoints", "best_checkpoint", "best_metric", "last_checkpoint")
    assert got == sorted(tuple(r[c] for c in columns) for r in whole)
    kept = {p for r in whole for p in r["checkpoints"]}
    assert gone == sorted((run, step, path) for run, step, path, _ in rows if path not in kept)
    assert len(catalog.complete_versions(spark, folder)) == 2


def test_replays_change_nothing(spark, tmp_path):
    folder = str(tmp_path / "c")
    _, parts = batches(5)
    upsert = catalog.upsert_checkpoints(folder, 2)
    for number, part in enumerate(parts):
        upsert(spark.createDataFrame(part, SCHEMA), number)
        before = state(spark, folder)
        upsert(spark.createDataFrame(part, SCHEMA), number)
        assert state(spark, folder) == before
    upsert(spark.createDataFrame(parts[0], SCHEMA), 0)
    assert state(spark, folder) == before


def test_a_batch_that_was_cut_short_is_taken_again(spark, tmp_path, monkeypatch):
    folder, other = str(tmp_path / "c"), str(tmp_path / "d")
    _, parts = batches(6)
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    for number, frame in enumerate(frames):
        catalog.upsert_checkpoints(other, 2)(frame, number)
    upsert = catalog.upsert_checkpoints(folder, 2)
    upsert(frames[0], 0)
    before = state(spark, folder)
    create = catalog._path
    monkeypatch.setattr(catalog, "_path", lambda s, n: create(s, n) if not n.endswith("version=1/_COMPLETE") else 1 / 0)
    with pytest.raises(ZeroDivisionError):  # all tables are written, the marker is not
        upsert(frames[1], 1)
    assert state(spark, folder) == before
    monkeypatch.undo()
    for number in (1, 2, 3):
        upsert(frames[number], number)
    assert state(spark, folder) == state(spark, other)


def test_edges(spark, tmp_path):
    folder = str(tmp_path / "c")
    assert state(spark, folder) == ([], [])
    upsert = catalog.upsert_checkpoints(folder, 1)
    upsert(spark.createDataFrame([], SCHEMA), 0)
    assert state(spark, folder) == ([], [])
    nan = float("nan")
    upsert(spark.createDataFrame([("r", 1, "a", nan), ("r", 1, "a", nan), (None, 1, "x", 0.1), ("r", None, "x", 0.1)], SCHEMA), 1)
    assert catalog.read_catalog(spark, folder).first()["checkpoints"] == ["a"]
    upsert(spark.createDataFrame([("r", 1, "b", 2.0), ("q", 4, "c", None)], SCHEMA), 2)  # step 1 once more, at a new path
    got, gone = state(spark, folder)
    assert got == [("q", ["c"], None, None, "c"), ("r", ["b"], "b", 2.0, "b")] and gone == [("r", 1, "a")]
    paths = resolve_from_catalog(catalog.read_catalog(spark, folder), load_best=True).collect()
    assert {r["run_id"]: r["path"] for r in paths} == {"q": "c", "r": "b"}
