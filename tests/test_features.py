import math

import pytest

from riskloom.operators import features
from riskloom.schemas import FEATURE_COLUMNS, TARGET


def one(df):
    return df.first().asDict()


def test_logs_clamp_in_place(spark):
    df = spark.createDataFrame([(-5.0, None, 3.0, 0.0)], "income double, weight double, count double, looped double")
    row = one(features.add_logs(df))
    assert [row[c] for c in df.columns] == [0.0, 0.0, 3.0, 0.0]
    assert [row[f"log_{c}"] for c in df.columns] == pytest.approx([0, 0, math.log(4), 0])


def test_clamp_keeps_nan_and_turns_whole_numbers_into_doubles(spark):
    df = spark.createDataFrame([(math.nan, 7)], "income double, count long")
    out = features.add_logs(df, ["income", "count"])
    assert dict(out.dtypes)["count"] == "double"
    row = one(out)
    assert math.isnan(row["income"]) and row["count"] == 7.0


@pytest.mark.parametrize("values, expected", [
    ((4.0, 6.0, 1.0, 10.0, 21.0), (5.0, 2.0, 3.0)),
    ((0.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0)),
    ((1e6, 1e6, 1e6, 1e6, 1e6), (2e6 / 1000001, 1e6 / 1000001, 1e6 / 1000001)),
    ((1.0, 1e12, 0.0, 1.0, 1.0), (1e12 + 1, 0.5, 1 / (1e12 + 1))),
])
def test_ratios(spark, values, expected):
    df = spark.createDataFrame([values], "count double, neighbors double, looped double, weight double, income double")
    row = one(features.add_ratios(df))
    assert (row["activity_index"], row["weight_to_count"], row["income_per_neighbor"]) == pytest.approx(expected)


def test_zero_divisor_gives_null(spark):
    df = spark.createDataFrame([(1, -1, -1, 1.0, 1.0)], "count long, neighbors long, looped long, weight double, income double")
    row = one(features.add_ratios(df))
    assert row["income_per_neighbor"] is None and row["activity_index"] is None


@pytest.mark.parametrize("year, day, days, angle_day", [
    (2009, 1, 1, 1), (2011, 100, 830, 100), (2010, 3650, 4015, 3650), (None, None, 0, 0), (2012, None, 1095, 0),
])
def test_calendar(spark, year, day, days, angle_day):
    row = one(features.add_calendar(spark.createDataFrame([(year, day)], "year int, day int")))
    assert row["days_since_2009"] == days
    angle = 2 * math.pi * angle_day / 365
    assert (row["sin_day"], row["cos_day"]) == pytest.approx((math.sin(angle), math.cos(angle)), abs=1e-9)


def test_composite_adds_all_stateless_features(raw_rows):
    out = features.add_stateless(raw_rows)
    assert set(FEATURE_COLUMNS) - set(out.columns) == {"income_z", "income_z_by_year"}


def test_align_orders_fills_and_drops(spark):
    df = spark.createDataFrame([(1, None, 5.0, "x")], "b int, a double, extra double, id string")
    out = features.align(df, ["a", "b", "absent"], keep=["id"])
    assert out.columns == ["id", "a", "b", "absent"]
    assert tuple(out.first()) == ("x", 0.0, 1.0, 0.0)


def test_feature_columns_need_the_target(spark):
    with pytest.raises(ValueError, match=TARGET):
        features.feature_columns(spark.range(1))
    assert features.feature_columns(spark.range(1).withColumnRenamed("id", TARGET)) == []


def test_unmodelled_columns_go(raw_rows):
    assert not {"year", "income", "length"} & set(features.drop_unmodelled(raw_rows).columns)
