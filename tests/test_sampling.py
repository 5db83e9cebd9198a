"""Exact sampling against brute force, with copies and hot keys."""

import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import sampling


def md5(key, seed=42):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


def by_hash(keys):
    return sorted(keys, key=md5)


def numbers(spark, n, positives):
    return spark.range(n).select(F.col("id"), (F.col("id") < positives).cast("int").alias("y"))


def test_take_first_is_the_head_of_the_hash_order(spark):
    df = numbers(spark, 3000, 700)
    taken = sampling.take_first(df, "y", lambda n: {0: n[1]}, ["id"])
    zero = {r.id for r in taken.where("y = 0").collect()}
    assert zero == set(by_hash(range(700, 3000))[:700])
    assert taken.where("y = 1").count() == 700


def test_buckets_within_buckets_find_the_same_rows(spark, monkeypatch):
    df = numbers(spark, 3000, 0)
    one_level = sorted(sampling.assign_folds(df, ["id"], "y", 4).collect())
    monkeypatch.setattr(sampling, "ROWS_PER_TASK", 1)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    assert sorted(sampling.assign_folds(df, ["id"], "y", 4).collect()) == one_level


def test_sample_is_a_filter_without_shuffle(spark, tmp_path):
    numbers(spark, 2000, 500).write.parquet(str(tmp_path / "t"))
    taken = sampling.take_first(spark.read.parquet(str(tmp_path / "t")), "y", lambda n: {0: n[1]}, ["id"])
    plan = taken._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("quota", [0, 1, 999, 1000, 2000])
def test_quota_bounds(spark, quota):
    df = numbers(spark, 1000, 0)
    assert sampling.take_first(df, "y", lambda n: {0: quota}, ["id"]).count() == min(quota, 1000)


def test_split_is_disjoint_whole_and_stratified(spark):
    df = numbers(spark, 1003, 400)
    split = sampling.stratified_split(df, ["id"], "y")
    counts = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    assert sum(counts.values()) == 1003
    assert counts[0, "test"] + counts[1, "test"] == 201
    assert abs(counts[1, "test"] - 400 * 0.2) <= 1
    assert split.select("id").distinct().count() == 1003


def test_split_needs_the_target(spark):
    with pytest.raises(ValueError, match="is_ransomware"):
        sampling.stratified_split(spark.range(3), ["id"])


@pytest.mark.parametrize("sizes, expected", [
    ({0: 50, 1: 50}, {0: 40, 1: 40}),
    ({0: 7, 1: 7}, {0: 6, 1: 5}),
    ({0: 1, 1: 9}, {0: 1, 1: 7}),
])
def test_train_sizes_share_the_exact_total(sizes, expected):
    assert sampling.train_sizes(sizes, 0.2) == expected


def test_folds_are_even_per_class(spark):
    folded = sampling.assign_folds(numbers(spark, 100, 41), ["id"], "y", 3)
    counts = {(r.y, r.fold): r["count"] for r in folded.groupBy("y", "fold").count().collect()}
    assert sorted(counts[1, k] for k in range(3)) == [13, 14, 14]
    assert sorted(counts[0, k] for k in range(3)) == [19, 20, 20]


def test_folds_follow_the_hash_order(spark):
    folded = sampling.assign_folds(numbers(spark, 90, 0), ["id"], "y", 3)
    order = by_hash(range(90))
    assert {r.id: r.fold for r in folded.collect()} == {k: i // 30 for i, k in enumerate(order)}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(copies=st.lists(st.integers(1, 40), min_size=1, max_size=8), share=st.floats(0, 1))
def test_copies_are_divided_exactly(spark, copies, share):
    rows = [(i, 0) for i, n in enumerate(copies) for _ in range(n)]
    quota = round(share * len(rows))
    df = spark.createDataFrame(rows, "id int, y int")
    got = Counter(r.id for r in sampling.take_first(df, "y", lambda n: {0: quota}, df.columns).collect())
    assert sum(got.values()) == quota
    assert all(n <= copies[i] for i, n in got.items())
    # Groups come whole and in order; only one of them is cut.
    assert sum(1 for i, n in got.items() if n < copies[i]) <= 1


def test_a_third_of_all_rows_are_copies(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_TASK", 1000)
    monkeypatch.setattr(sampling, "ROWS_PER_TASK", 2)
    hot = spark.range(10_000).select(F.lit(-1).cast("long").alias("id"), F.lit(0).alias("y"))
    df = numbers(spark, 20_000, 0).unionByName(hot)
    folded = sampling.assign_folds(df, ["id"], "y", 5)
    assert {r.fold: r["count"] for r in folded.groupBy("fold").count().collect()} == dict.fromkeys(range(5), 6000)
    assert folded.where("id = -1").count() == 10_000
    assert folded.where("id >= 0").distinct().count() == 20_000


def test_key_shared_by_different_rows(spark):
    """One key holds a third of the rows, which differ elsewhere: nothing is lost or doubled."""
    df = spark.range(900).select(
        F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("v"), F.lit(1).alias("y")
    )
    folded = sampling.assign_folds(df, ["key"], "y", 9)
    assert {r.fold: r["count"] for r in folded.groupBy("fold").count().collect()} == dict.fromkeys(range(9), 100)
    assert folded.select("v").distinct().count() == 900


def test_bootstrap_draws_by_rank(spark):
    df = spark.range(500)
    order = by_hash(range(500))
    drawn = {r.draw: r.id for r in sampling.bootstrap(df, ["id"], 200).collect()}
    assert drawn == {
        i: order[int(hashlib.md5(f"draw:{i}:42".encode()).hexdigest()[:15], 16) % 500] for i in range(200)
    }


def test_bootstrap_of_copies_keeps_their_weight(spark):
    hot = spark.range(1000).select(F.lit(-1).cast("long").alias("id"))
    drawn = sampling.bootstrap(spark.range(2000).unionByName(hot), ["id"], 3000)
    assert drawn.count() == 3000
    assert 900 < drawn.where("id = -1").count() < 1100


def test_bootstrap_of_nothing(spark):
    with pytest.raises(ValueError):
        sampling.bootstrap(spark.range(0), ["id"])


def test_missing_values_come_at_the_given_rate(spark):
    df = spark.range(20_000).select("id", F.lit(1.0).alias("a"), F.lit(2.0).alias("b"))
    out = sampling.inject_missing(df, ["a", "b"], ["id"], 0.05)
    a, b, both = out.select(
        F.expr("count_if(a IS NULL)"), F.expr("count_if(b IS NULL)"), F.expr("count_if(a IS NULL AND b IS NULL)")
    ).first()
    assert 850 < a < 1150 and 850 < b < 1150 and both < 100


def test_too_many_strata_are_refused(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MAX_STRATA", 3)
    with pytest.raises(ValueError, match="more than 3"):
        sampling.stratified_split(spark.range(9).withColumn("is_ransomware", F.col("id")), ["id"])
