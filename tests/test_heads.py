import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import ordering


@pytest.fixture
def narrow(monkeypatch):
    """Few keys are sorted and few sampled, so that small tables take several passes."""
    monkeypatch.setattr(ordering, "SORTED_KEYS", 40)
    monkeypatch.setattr(ordering, "SAMPLED_KEYS", 100)


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])


def test_nth_key_in_several_passes(spark, narrow):
    rng = random.Random(3)
    # A third of the rows share the first key, and some have none.
    rows = [(rng.choice([7, 7, None, *range(12)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7).cache()
    for n in (1, 2, 40, 41, 999, 1500, 2959, 2999, 3000):
        assert ordering.nth_key(df, ["a", "b"], n) == ordered(rows)[n - 1]
        assert ordering.head_rows(df, ["a", "b"], n).count() == n
    assert ordering.nth_key(df, ["a", "b"], 3001) is None
    assert ordering.nth_key(df.limit(0), ["a", "b"], 1) is None


def test_equal_keys_end_the_search(spark, narrow):
    rows = [(0,)] * 20 + [(5,)] * 900 + [(9,)] * 80
    df = spark.createDataFrame(rows, "a int")
    assert [ordering.nth_key(df, ["a"], n) for n in (20, 21, 500, 920, 921)] == [(0,), (5,), (5,), (5,), (9,)]
    assert ordering.head_rows(df, ["a"], 21).count() == 920  # rows equal to the n-th stay with it


def test_heads_of_groups_in_several_passes(spark, narrow):
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("g"), (-F.col("id")).alias("k"))
    got = ordering.head_per_group(df, "g", ["k"], {"small": 500, "large": 700, "absent": 3})
    assert {r["g"]: r["count"] for r in got.groupBy("g").count().collect()} == {"small": 200, "large": 700}
    kept = [-r["k"] for r in got.filter("g = 'large'").collect()]
    assert sorted(kept) == [i for i in range(2000) if i % 10][-700:]
    assert ordering.head_per_group(df, "g", ["k"], {"large": 0}).count() == 0


def test_heads_write_nothing_and_shuffle_no_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "materialize", lambda *_: pytest.fail("a table was written"))
    spark.range(1000).withColumn("text", F.lit("x")).write.parquet(str(tmp_path / "t"))
    head = ordering.head_rows(spark.read.parquet(str(tmp_path / "t")), ["id"], 100)
    plan = head._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [Or(IsNull(id),LessThanOrEqual(id,99))]" in plan or "LessThan(id,99)" in plan
    assert head.count() == 100
