"""Profiles against numpy and pandas, and drift against a plain sum."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import drift as d
from riskloom.operators import profile as p
from riskloom.sources import tables


def brute_profile(values):
    x = pd.Series([v for v in values if v is not None and not math.isnan(v)], dtype=float)
    n = len(x)
    if n < 3:
        bins = 1
    else:
        sigma = math.sqrt(6 * (n - 2) / ((n + 1) * (n + 3)))
        bins = max(1, int(round(1 + np.log2(n) + np.log2(1 + abs(x.skew()) / sigma))))
    hist, edges = np.histogram(x, bins=bins)
    return hist.tolist(), edges.tolist(), x.mean(), x.std()


def frame(spark, **columns):
    return spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(-1000, 1000).map(lambda v: round(v, 2))), min_size=3, max_size=80)
       .filter(lambda v: any(x is not None for x in v)))
def test_profile_equals_numpy(spark, values):
    row = p.profile(frame(spark, income=values), ["income"]).first()
    hist, edges, mean, std = brute_profile(values)
    assert row.hist == hist
    assert row.bin_edges == pytest.approx(edges, rel=1e-12, abs=1e-9)
    assert row.num_bins == len(hist)
    assert row["mean"] == pytest.approx(mean, abs=1e-9)
    assert (row["std"] is None and math.isnan(std)) or row["std"] == pytest.approx(std, abs=1e-9)
    assert row.missing_ratio == pytest.approx(sum(v is None for v in values) / len(values))


def test_profile_of_skewed_data(spark):
    values = np.random.default_rng(7).lognormal(3, 2, 5000).tolist()
    row = p.profile(frame(spark, income=values), ["income"]).first()
    assert row.hist == brute_profile(values)[0]
    assert sum(row.hist) == 5000


def test_constant_and_short_columns(spark):
    df = frame(spark, income=[5.0] * 10, weight=[1.0] * 8 + [None, math.nan])
    rows = {r.feature: r for r in p.profile(df, ["income", "weight"]).collect()}
    assert rows["income"].bin_edges[0] == 4.5 and rows["income"].bin_edges[-1] == 5.5
    assert rows["income"].hist == brute_profile([5.0] * 10)[0]
    assert rows["weight"].missing_ratio == 0.2
    assert p.profile(frame(spark, income=[1.0, 2.0]), ["income"]).first().num_bins == 1


def test_profile_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "income double, weight double")
    row = p.profile(df, ["income", "weight"]).where("feature = 'income'").first()
    assert row.missing_ratio == 1.0
    assert [row[c] for c in ("mean", "std", "hist", "bin_edges", "num_bins")] == [None] * 5


def test_same_data_has_no_drift(spark):
    df = frame(spark, income=[float(i % 17) for i in range(300)])
    assert d.drift(p.profile(df, ["income"]), df, ["income"]).first().psi == 0.0


def brute_psi(hist, edges, live):
    counts, _ = np.histogram(live, bins=edges)
    a, b = np.array(hist) / sum(hist) + 1e-6, counts / counts.sum() + 1e-6
    return float(((b - a) * np.log(b / a)).sum())


def test_drift_equals_plain_sum(spark):
    rng = np.random.default_rng(3)
    reference, live = rng.normal(0, 1, 2000).tolist(), (rng.normal(0.4, 1.3, 500)).tolist()
    stored = p.profile(frame(spark, income=reference), ["income"])
    holes = [None if i % 10 == 0 else v for i, v in enumerate(live)]
    found = d.drift(stored, frame(spark, income=holes), ["income"]).first()
    there = [v for v in holes if v is not None]
    row = stored.first()
    assert found.psi == pytest.approx(brute_psi(row.hist, row.bin_edges, there))
    assert found.missing_ratio == pytest.approx(0.1)
    assert found["mean"] == pytest.approx(np.mean(there)) and found["std"] == pytest.approx(np.std(there, ddof=1))


def test_uneven_edges_are_followed(spark):
    from riskloom.functions.binning import edge_bin

    edges = [0.0, 1.0, 10.0, 11.0, 100.0]
    values = [-0.1, 0.0, 0.5, 1.0, 9.9, 10.0, 10.5, 11.0, 99.0, 100.0, 100.1]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.b for r in df.select(edge_bin(F.col("x"), F.array(*map(F.lit, edges))).alias("b")).collect()]
    assert got == [None, 0, 0, 1, 1, 2, 2, 3, 3, 3, None]


def test_reasons_without_index(spark):
    ref = spark.createDataFrame([(1.0, None, 1.0, 1.0), (2.0, None, 2.0, 3.0)], "a double, b double, c double, e double")
    stored = p.profile(ref, ["a", "b", "c", "e"])
    live = spark.createDataFrame([(None, 1.0, 50.0), (None, 2.0, 60.0)], "a double, b double, c double")
    found = {r.feature: (r.psi, r.reason) for r in d.drift(stored, live, ["a", "b", "c", "e", "z"]).collect()}
    assert found == {
        "a": (None, "no_live_values"),
        "b": (None, "no_reference_values"),
        "c": (None, "no_live_values_in_bins"),
        "e": (None, "unknown_feature"),
        "z": (None, "unknown_feature"),
    }


def test_profile_round_trips(spark, tmp_path):
    stored = p.profile(spark.createDataFrame([(1.0, None), (4.0, None), (9.0, None)], "income double, weight double"), ["income", "weight"])
    tables.save_profile(stored, str(tmp_path / "t"))
    tables.save_profile_json(stored, str(tmp_path / "j"))
    expected = sorted(stored.collect())
    assert sorted(tables.load_profile(spark, str(tmp_path / "t")).collect()) == expected
    assert sorted(tables.load_profile_json(spark, str(tmp_path / "j")).collect()) == expected


def test_profile_reads_its_input_twice(spark, tmp_path):
    """Once for the summary, which is written, and once for the bins."""
    spark.range(50).selectExpr("id * 1.0 AS income").write.parquet(str(tmp_path / "t"))
    found = p.profile(spark.read.parquet(str(tmp_path / "t")), ["income"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_path}/t]") == 1 and plan.count("FileScan") == 3
