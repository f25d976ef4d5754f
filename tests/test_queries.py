import pytest
from compare import differences, expected

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF).toPandas(), expected(ORACLE[name], SF)) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE)))
def test_other_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
