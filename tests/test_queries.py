import pytest

from treeflow.queries import ORACLE_SQL, QUERIES, SPECS


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(SPECS) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def test_filters_and_columns_reach_the_scan(spark):
    from tests.conftest import DATA

    plan = QUERIES["missing_ids"](spark, DATA)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan and "ReadSchema: struct<c_custkey:bigint>" in plan
