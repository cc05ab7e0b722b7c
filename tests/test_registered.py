"""Every registered query against its SQL on the smallest tables."""

import pytest

from rankloom.workload import oracle_sql, queries

from compare import connection, difference, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_each_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, con, name):
    ours = spark_rows(queries()[name], spark, SF_DIR)
    assert difference(ours, sql_rows(con, oracle_sql()[name])) is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
