"""Address rows from orders and their lines."""

import pytest
from pyspark.sql import functions as F

from riskloom.sources import star


@pytest.fixture
def found(spark, tmp_path):
    """Order 1 has lines that share suppliers and parts, some without one; order 2 has many lines; order 3 has none; some lines have no order."""
    lines = [(1, 10, 100, 1, 0.1), (1, 10, 101, 2, 0.2), (1, None, 100, 3, None), (1, 11, None, 4, 0.0), (None, 10, 100, 1, 0.5), (9, 10, 100, 1, 0.5)]
    lines += [(2, i % 7, i % 300, i % 5, 0.01) for i in range(2000)]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_discount double").repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(i, 5.0 * i, "1-URGENT") for i in (1, 2, 3)], "o_orderkey long, o_totalprice double, o_orderpriority string")
    orders.withColumn("o_orderdate", F.lit("1996-02-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "orders.parquet"))
    return star.addr(spark, str(tmp_path))


def test_sums_and_distinct_counts(found):
    rows = {r.address: (r.length, r.weight, r["count"], r.looped, r.neighbors, r.income) for r in found.collect()}
    assert rows == {1: (4, 0.3, 4, 2, 2, 5.0), 2: (4, 20.0, 2000, 1993, 300, 10.0), 3: (0, 0.0, 0, 0, 0, 15.0)}
    assert dict(found.dtypes)["looped"] == dict(found.dtypes)["neighbors"] == "bigint"


def test_lines_are_not_multiplied(found):
    """Several distinct counts at once would write every line out once for each of them."""
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
