import random
from types import SimpleNamespace

import pytest

from corpusflow.operators import segments


def placed(spark, path):
    return sorted((r["position"], r["start"], r["k"], r["w"]) for r in segments.read_rows(spark, path).collect())


def expected(parts):
    rows, total = [], 0
    for part in parts:
        for k, w in sorted(part):
            rows.append((len(rows), total, k, w))
            total += w
    return rows


def test_appends_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(4)
    parts = [[(1000 * p + i, rng.randint(0, 9)) for i in rng.sample(range(400), n)] for p, n in enumerate((300, 1, 0, 57))]
    path = str(tmp_path / "c")
    for part in parts:
        segments.append_rows(spark.createDataFrame(part, "k int, w int").repartition(5), path, ["k"], "w")
    assert placed(spark, path) == expected(parts)
    whole = str(tmp_path / "w")
    assert segments.append_rows(spark.createDataFrame(sum(parts, []), "k int, w int"), whole, ["k"], "w") == 0
    assert placed(spark, whole) == placed(spark, path)


def test_an_append_leaves_earlier_files_alone(spark, tmp_path):
    path = str(tmp_path / "c")
    segments.append_rows(spark.createDataFrame([(1, 2)], "k int, w int"), path, ["k"], "w")
    files = {f: f.read_bytes() for f in (tmp_path / "c" / "rows").rglob("*.parquet")}
    for file in files:
        file.write_bytes(b"unreadable")  # an append that read earlier rows would fail
    segments.append_rows(spark.createDataFrame([(2, 3)], "k int, w int"), path, ["k"], "w")
    for file, content in files.items():
        file.write_bytes(content)
    assert placed(spark, path) == [(0, 0, 1, 2), (1, 2, 2, 3)]


def test_replayed_and_interrupted_appends(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    first, second = (spark.createDataFrame(r, "k int, w int") for r in ([(2, 5), (1, 1)], [(0, 7)]))
    for _ in range(2):
        assert segments.append_rows(first, path, ["k"], "w", number=3) == 3
    # The rows are written, their segments are not.
    monkeypatch.setattr(segments, "F", SimpleNamespace(**{**vars(segments.F), "sum": lambda *_: 1 / 0}))
    with pytest.raises(ZeroDivisionError):
        segments.append_rows(second, path, ["k"], "w", number=4)
    monkeypatch.undo()
    assert list((tmp_path / "c" / "rows" / "append=4").glob("*.parquet"))
    assert placed(spark, path) == expected([[(1, 1), (2, 5)]])
    segments.append_rows(second, path, ["k"], "w", number=4)
    assert placed(spark, path) == expected([[(1, 1), (2, 5)], [(0, 7)]])


def test_without_weight(spark, tmp_path):
    path = str(tmp_path / "c")
    for low in (5, 0):
        segments.append_rows(spark.range(low, low + 3), path, ["id"])
    got = [(r["id"], r["position"], r["start"]) for r in segments.read_rows(spark, path).orderBy("position").collect()]
    assert got == [(i, n, 0) for n, i in enumerate((5, 6, 7, 0, 1, 2))]
