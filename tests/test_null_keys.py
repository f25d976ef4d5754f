"""Rows whose keys or groups are NULL are rows like any other."""

from corpusflow.operators.ordering import group_positions, head_per_group, head_rows, newest_per_group
from corpusflow.operators.samples import validation_cap

ROWS = [("a", 1), ("a", 2), ("a", None), (None, 1), (None, 2), (None, 3)]


def table(spark):
    return spark.createDataFrame(ROWS, "g string, k int")


def test_heads_count_null_keys(spark):
    for n in range(8):
        assert head_rows(table(spark), ["g", "k"], n).count() == min(n, 6)
    assert head_per_group(table(spark), "g", ["k"], {"a": 2}).count() == 2
    assert head_per_group(table(spark), "g", ["k"], {"a": 9}).count() == 3


def test_groups_without_a_name_stay(spark):
    found = group_positions(table(spark), ["g"], ["k"])
    assert sorted(r["row"] for r in found.filter("g IS NULL").collect()) == [0, 1, 2] and found.count() == 6


def test_newest_rows_do_not_depend_on_the_threshold(spark):
    for n in (1, 2, 5, 5000):
        assert newest_per_group(table(spark), "g", ["k"], n).count() == 2 * min(n, 3)


def test_a_cap_of_zero_is_a_cap():
    assert validation_cap(0) == 0 and validation_cap(None) is None
