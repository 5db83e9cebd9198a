"""Every query against the other engine, on the smallest data set."""

import pytest

import __spark_entry__ as contract
from compare import oracle_rows, spark_rows
from riskloom.plans import oracles, queries as catalog

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
QUERIES, SQL = catalog.ALL, oracles.ALL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    types, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    sql_types, sql_rows = oracle_rows(SF_DIR, SQL[name])
    assert {c: TYPES[t] for c, t in types.items()} == sql_types
    assert rows == sql_rows
    assert rows or name in {"down_alert", "error_rate_alert", "stream_error_states"}


def test_all_have_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    from riskloom.schemas import FEATURE_COLUMNS, TARGET

    result = contract.entry(spark)
    assert result.columns == [TARGET, *FEATURE_COLUMNS]
    assert result.count() > 0
