
import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.operators import zscore
from riskloom.sources import tables


@pytest.fixture
def incomes(spark):
    rows = [(2010, 1.0), (2010, 3.0), (2011, 5.0), (2012, 4.0), (2012, 4.0), (None, 10.0)]
    return spark.createDataFrame(rows, "year int, income double")


def test_state_matches_pandas(incomes):
    state = {(r.scope, r.year): (r["mean"], r["std"]) for r in zscore.fit_state(incomes).collect()}
    pdf = incomes.toPandas()
    assert state["global", None] == pytest.approx((pdf.income.mean(), pdf.income.std(ddof=0)))
    assert state["year", 2010] == pytest.approx((2.0, 1.0))
    # One row, or equal rows: a deviation of one.
    assert state["year", 2011] == (5.0, 1.0) and state["year", 2012] == (4.0, 1.0)
    assert len(state) == 4


def test_apply_gives_null_only_for_unseen_years(incomes):
    state = zscore.fit_state(incomes.where("year = 2010"))
    rows = zscore.apply_state(incomes, state).toPandas()
    assert rows.income_z.tolist() == [-1.0, 1.0, 3.0, 2.0, 2.0, 8.0]
    assert rows.income_z_by_year.dropna().tolist() == [-1.0, 1.0]
    assert "_mean" not in rows


def test_fitted_scores_are_standard(spark):
    df = spark.range(1000).select((F.col("id") % 5 + 2010).cast("int").alias("year"), (F.hash("id") % 97).cast("double").alias("income"))
    out = zscore.apply_state(df, zscore.fit_state(df)).toPandas()
    assert out.income_z.mean() == pytest.approx(0, abs=1e-9) and out.income_z.std(ddof=0) == pytest.approx(1)
    by_year = out.groupby("year").income_z_by_year.agg(["mean", lambda s: s.std(ddof=0)])
    assert by_year.values.ravel().tolist() == pytest.approx([0, 1] * 5, abs=1e-9)


def test_unfitted_state_is_refused(incomes, tmp_path):
    nothing = zscore.fit_state(incomes.where("false"))
    with pytest.raises(RuntimeError, match="fit it first"):
        zscore.apply_state(incomes, nothing)
    with pytest.raises(RuntimeError, match="fit it first"):
        tables.save_state(nothing, str(tmp_path / "state"))


def test_state_round_trip(spark, incomes, tmp_path):
    state = zscore.fit_state(incomes)
    tables.save_state(state, str(tmp_path / "state"))
    assert sorted(tables.load_state(spark, str(tmp_path / "state")).collect(), key=str) == sorted(state.collect(), key=str)


def test_broadcast_only_below_the_bound(spark, incomes, monkeypatch, tmp_path):
    state = zscore.fit_state(incomes)

    def hinted():
        return "strategy=broadcast" in zscore.apply_state(incomes, state)._jdf.queryExecution().logical().toString()

    assert hinted()
    expected = sorted(zscore.apply_state(incomes, state).collect(), key=str)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 2)
    assert not hinted()
    assert sorted(zscore.apply_state(incomes, state).collect(), key=str) == expected
