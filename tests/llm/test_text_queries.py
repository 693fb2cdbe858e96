"""Every text query on the smallest tables; those with SQL against it."""

import oracle
import pytest

import corpus_pipeline
from eventmill.llm import queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.all_queries()
ORACLES = queries.all_oracles()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, rows = oracle.spark_rows(df)
    expected_columns, expected = oracle.sql_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected
    assert oracle.type_differences(df, con, ORACLES[name]) == []


def test_registered():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in entry.oracle_sql()
