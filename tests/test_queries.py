"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest

from eventmill import plans

SF_DIR = "/root/testdata/sf0.001"
QUERIES = plans.all_queries()
ORACLES = plans.all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, rows = oracle.spark_rows(df)
    expected_columns, expected = oracle.sql_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert oracle.type_differences(df, con, ORACLES[name]) == []


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
