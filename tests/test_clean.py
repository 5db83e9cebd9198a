import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators import clean
from riskloom.schemas import NUMERIC_COLUMNS, RAW, TARGET


def test_fill_replaces_null_and_nan(spark):
    row = ("a", None, None, None, math.nan, None, None, None, math.nan, "white")
    filled = clean.fill_numeric(spark.createDataFrame([row], RAW)).first()
    assert [filled[c] for c in NUMERIC_COLUMNS] == [0] * 8


def test_preprocess_balances_and_binarises(raw_rows):
    out = clean.preprocess(raw_rows)
    assert "address" not in out.columns and "label" not in out.columns
    assert {r[TARGET]: r["count"] for r in out.groupBy(TARGET).count().collect()} == {0: 3, 1: 3}


def test_positive_rows_all_stay(raw_rows):
    out = clean.preprocess(raw_rows).where(f"{TARGET} = 1")
    assert sorted(r.income for r in out.collect()) == [500.0, 600.0, 700.0]


def test_result_does_not_depend_on_partitions(raw_rows):
    a = clean.preprocess(raw_rows.repartition(1)).collect()
    b = clean.preprocess(raw_rows.repartition(7)).collect()
    assert sorted(a) == sorted(b)


def test_rows_without_label_belong_to_no_class(spark, raw_rows):
    nobody = raw_rows.limit(4).withColumn("label", F.lit(None).cast("string"))
    both = raw_rows.unionByName(nobody)
    assert {r[TARGET]: r["n"] for r in clean.class_counts(both).collect()} == {0: 5, 1: 3, None: 4}
    assert clean.preprocess(both).count() == 6


def test_no_clean_rows(raw_rows):
    with pytest.raises(ValueError, match="white"):
        clean.preprocess(raw_rows.where("label <> 'white'"))


def test_more_positive_than_clean_rows(raw_rows):
    with pytest.raises(ValueError, match="Cannot balance 3 positive rows with only 2"):
        clean.preprocess(raw_rows.where("label <> 'white' OR address IN ('a0', 'a1')"))


def test_no_positive_rows_gives_an_empty_table(raw_rows):
    assert clean.preprocess(raw_rows.where("label = 'white'")).count() == 0
