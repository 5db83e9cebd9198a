"""State and splits that loads are added to, against one pass over everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import growing, moments, profile, sampling, zscore
from riskloom.session import at_rest
from riskloom.sources import star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return at_rest(star.addr_dirty(spark, SF_DIR).withColumn("income", F.col("income") + 1e9), "rows")


def loads(df, n):
    return [df.where(F.pmod("address", F.lit(n)) == i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_moments_of_loads_are_those_of_the_union(spark, rows, n):
    """Incomes far from zero, where plain sums of squares would lose all digits."""
    parts = [moments.load_moments(r) for r in loads(rows, n)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    merged = at_rest(merged, "moments")
    state = {(r.scope, r.year): r for r in moments.zscore_state(merged).collect()}
    expected = {(r.scope, r.year): r for r in zscore.fit_state(rows).collect()}
    assert state.keys() == expected.keys()
    for k, r in expected.items():
        assert (state[k]["mean"], state[k]["std"]) == pytest.approx((r["mean"], r["std"]), rel=1e-9)
    got, whole = ({r.feature: r.asDict() for r in d.collect()} for d in (moments.profile_summary(merged), profile.summarise(rows)))
    assert got.keys() == whole.keys()
    for name, r in whole.items():
        for c, v in r.items():
            assert got[name][c] == (v if isinstance(v, (str, int)) or v is None else pytest.approx(v, rel=1e-7, abs=1e-9)), (name, c)


def test_moments_without_values_and_of_equal_ones(spark):
    schema = "year int, income double, neighbors double, weight double"
    a = spark.createDataFrame([(1, None, 2.0, float("nan")), (2, None, 2.0, 1.0)], schema)
    b = spark.createDataFrame([(1, None, 2.0, 4.0)], schema)
    empty = spark.createDataFrame([], schema)
    parts = moments.load_moments(a).unionByName(moments.load_moments(b)).unionByName(moments.load_moments(empty))
    got = {r.feature: r for r in moments.profile_summary(parts).collect()}
    whole = {r.feature: r for r in profile.summarise(a.unionByName(b)).collect()}
    assert {k: tuple(v) for k, v in got.items()} == {k: pytest.approx(tuple(v)) if None not in tuple(v) else tuple(v) for k, v in whole.items()}


def dealt(spark, parts, targets, key):
    cuts = spark.createDataFrame([], growing.CUTS)
    for i, part in enumerate(parts):
        before = {tuple(r) for r in cuts.collect()}
        cuts = at_rest(cuts.unionByName(growing.deal_load(part, i, cuts, key, targets)), "cuts")
        assert before <= {tuple(r) for r in cuts.collect()}  # nothing dealt before is touched
    return cuts


@pytest.mark.parametrize("targets, segments", [(growing.split_targets(0.2), 2), (growing.fold_targets(3), 3)])
def test_no_row_changes_sides_and_sizes_stay_right(spark, targets, segments):
    whole = at_rest(spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("is_ransomware")), "rows")
    parts = [whole.where("id < 500"), whole.where("id >= 500 AND id < 520"), whole.where("id >= 520 AND id < 521"), whole.where("id >= 521")]
    cuts = dealt(spark, parts, targets, ["id"])
    load = F.when(F.col("id") < 500, 0).when(F.col("id") < 520, 1).when(F.col("id") < 521, 2).otherwise(3).cast("long")
    seen = {}
    for upto, n in ((0, 500), (1, 520), (2, 521), (3, 3000)):
        marked = growing.apply_cuts(whole.withColumn("load", load), cuts.where(F.col("load") <= upto), ["id"])
        now = {r.id: r.segment for r in marked.collect()}
        assert len(now) == n and all(now[i] == s for i, s in seen.items())
        seen = now
        sizes = {r.is_ransomware: r["count"] for r in whole.where(F.col("id") < n).groupBy("is_ransomware").count().collect()}
        got = {(r.is_ransomware, r.segment): r["count"] for r in marked.groupBy("is_ransomware", "segment").count().collect()}
        for s, wanted in targets(sizes).items():
            assert np.abs(np.array([got.get((s, i), 0) for i in range(segments)]) - wanted).max() <= 1
    assert {tuple(r) for r in marked.groupBy(F.col("is_ransomware").cast("string"), "segment", "load").count().collect()} == {
        (r["class"], r.segment, r.load, r.rows) for r in cuts.where("rows > 0").collect()}


def test_first_load_is_the_plain_split(spark):
    whole = at_rest(spark.range(1000).select("id", (F.col("id") % 5 == 0).cast("int").alias("is_ransomware"), F.lit(0).cast("long").alias("load")), "rows")
    marked = growing.apply_cuts(whole, dealt(spark, [whole], growing.split_targets(), ["id"]), ["id"])
    plain = sampling.stratified_split(whole, ["id"])
    got = {(r.id, r.s) for r in marked.select("id", growing.named_split(F.col("segment")).alias("s")).collect()}
    assert got == {(r.id, r.split) for r in plain.collect()}


def test_copies_stay_together_and_null_classes_are_left_out(spark):
    df = spark.createDataFrame([(1, 0)] * 50 + [(i, 0) for i in range(2, 52)] + [(99, None)], "id long, is_ransomware int").withColumn("load", F.lit(0).cast("long"))
    marked = growing.apply_cuts(df, dealt(spark, [df], growing.split_targets(0.5), ["id"]), ["id"])
    assert marked.count() == 100 and marked.where("id = 1").select("segment").distinct().count() == 1


def test_shares():
    assert growing.shares(10, [4, 16], [2, 8]) == [2, 8]
    assert growing.shares(1, [5, 20], [2, 18]) == [1, 0]
    assert growing.shares(3, [2, 8], [5, 2]) == [0, 3]
    assert growing.shares(0, [2, 8], [2, 8]) == [0, 0]


def test_loads_added_one_by_one(spark, tmp_path):
    """A second load changes no row of the first one, and a load cut off before its cuts were written is made again."""
    from riskloom.plans import stages
    from riskloom.sources import tables

    raw, at, how = at_rest(star.raw(spark, SF_DIR), "raw"), stages.Layout(str(tmp_path / "root")), stages.Settings(key=["address"])
    seen = {}
    for i in (1, 2):
        csv = str(tmp_path / f"csv{i}")
        raw.where(F.pmod(F.xxhash64("address"), F.lit(2)) == i - 1).write.option("header", True).csv(csv)
        if i == 2:  # as after a crash: rows without cuts
            raw.limit(3).write.parquet(at.at("loads/load=2"))
            assert stages.load_features(spark, at, how).count() == len(seen)
        assert stages.load_stage(spark, at, csv, how) == i
        now = {r.address: (r.split, r.load) for r in stages.load_features(spark, at, how).collect()}
        assert all(now[a] == was for a, was in seen.items()) and {load for _, load in now.values()} == set(range(1, i + 1))
        seen = now
    found = stages.load_features(spark, at, how)
    test = found.where("split = 'test'").count() / found.count()
    assert abs(test - 0.2) < 0.002 and found.groupBy("is_ransomware").count().select("count").distinct().count() == 1
    fitted = {(r.scope, r.year): (r["mean"], r["std"]) for r in zscore.fit_state(found).collect()}
    saved = {(r.scope, r.year): (r["mean"], r["std"]) for r in tables.load_state(spark, at.at("load-state")).collect()}
    assert saved.keys() == fitted.keys() and all(saved[k] == pytest.approx(fitted[k], rel=1e-9) for k in fitted)


def test_a_load_parses_its_text_once(spark, tmp_path, monkeypatch):
    """The passes that look for cuts read columns at rest, not the CSV again."""
    from riskloom.plans import stages
    from riskloom.sources import tables

    parsed, read = spark.sparkContext.accumulator(0), tables.read_raw_csv

    def counted(address):
        parsed.add(1)
        return address

    marked = F.udf(counted, "string")
    monkeypatch.setattr(tables, "read_raw_csv", lambda *a: read(*a).withColumn("address", marked("address")))
    raw, csv = star.raw(spark, SF_DIR), str(tmp_path / "csv")
    raw.write.option("header", True).csv(csv)
    stages.load_stage(spark, stages.Layout(str(tmp_path / "root")), csv, stages.Settings(key=["address"]))
    assert parsed.value == raw.count()
