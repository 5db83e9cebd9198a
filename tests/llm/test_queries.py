"""The registered queries against SQL, on the smallest data set."""

import pytest

from compare import oracle_rows, spark_rows
from riskloom.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracles.ALL))
def test_same_rows(spark, name):
    types, rows = spark_rows(queries.ALL[name](spark, SF_DIR))
    sql_types, sql_rows = oracle_rows(SF_DIR, oracles.ALL[name])
    assert {c: TYPES[t] for c, t in types.items()} == sql_types
    assert rows == sql_rows != []


def test_one_query_for_each_number():
    assert [int(n[2:].split("_")[0]) for n in queries.ALL] == list(range(1, 14))
