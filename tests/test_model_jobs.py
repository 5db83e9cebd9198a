"""Model fitting and the batch stages from CSV to drift."""

import pytest
from pyspark.sql import functions as F

from riskloom import jobs
from riskloom.operators import model as m
from riskloom.operators.sampling import assign_folds
from riskloom.plans import stages
from riskloom.schemas import FEATURE_COLUMNS, PREDICTION_LOG, TARGET
from riskloom.sources import star, tables
from riskloom.streaming import monitor, sinks

SMALL = m.ForestSettings(trees=3, depth=4)


@pytest.fixture(scope="module")
def table(spark):
    """60 rows of three features, of which the first tells the classes apart."""
    x = F.rand(1)
    return spark.range(60).select(
        "id", (F.col("id") % 2).cast("int").alias(TARGET), (F.col("id") % 2 + x).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c")
    ).repartition(1)


@pytest.fixture(scope="module")
def trained(table):
    return m.train(table, ["a", "b", "c"], ["id"], SMALL)


def test_summary_and_report(trained):
    row = trained.summary.first()
    assert set(row.asDict()) == {"accuracy", "roc_auc", "f1_positive", "cv_test_f1_mean", "cv_test_f1_std"}
    assert row.roc_auc > 0.9 and row.accuracy > 0.9
    assert {r["class"] for r in trained.report.collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_fold_scores(trained):
    rows = trained.fold_scores.collect()
    assert len(rows) == 3 * 2 * 4 and all(0 <= r.value <= 1 for r in rows)


def test_model_keeps_its_contract(spark, trained, table, tmp_path):
    tables.save_model(trained.model, str(tmp_path / "m"))
    again = tables.load_model(str(tmp_path / "m"))
    assert m.contract(again) == ["a", "b", "c"]
    shuffled = table.select("id", "c", "b", "a", F.lit("x").alias("other"))
    before, after = (sorted(m.score(x, shuffled, ["id"]).collect()) for x in (trained.model, again))
    assert before == after
    assert {r.prediction for r in after} == {"ransomware", "clean"}
    assert all((r.probability >= 0.5) == (r.prediction == "ransomware") for r in after)


def test_absent_column_is_zero(trained, table):
    assert m.score(trained.model, table.drop("b"), ["id"]).count() == 60


def test_target_is_needed(trained, table):
    with pytest.raises(ValueError, match=TARGET):
        m.fit(table.drop(TARGET), ["a"], SMALL)
    with pytest.raises(ValueError, match=TARGET):
        m.evaluate(trained.model, table.drop(TARGET))


def test_training_rows_are_spread_over_tasks(table, monkeypatch):
    """One partition of 60 rows is read in parts of about 10; a table in enough partitions is left alone."""
    seen = []

    class Spy:
        def fit(self, rows):
            seen.append(rows)

    monkeypatch.setattr(m, "forest", lambda columns, settings: Spy())
    m.fit(table, ["a", "b"], SMALL)
    monkeypatch.setattr(m, "ROWS_PER_TASK", 10)
    m.fit(table, ["a", "b"], SMALL)
    m.fit(table.repartition(7), ["a", "b"], SMALL)
    assert [rows.rdd.getNumPartitions() for rows in seen] == [1, 6, 7]
    assert max(seen[1].groupBy(F.spark_partition_id()).count().toPandas()["count"]) <= 12
    assert sorted(seen[1].collect()) == sorted(table.select(TARGET, "a", "b").collect())


def test_folds_of_a_large_table_hold_one_model_at_a_time(table, monkeypatch):
    """Over many rows fits follow each other, and scores are counted before the next one; a few rows are fitted side by side."""
    events, fit, rest = [], m.fit, m.at_rest
    monkeypatch.setattr(m, "fit", lambda *a: (events.append("fit"), fit(*a), events.append("fitted"))[1])
    monkeypatch.setattr(m, "at_rest", lambda df, name: (rest(df, name), events.append(name))[0])
    folded = assign_folds(table, ["id"], TARGET)
    together = m.cross_validate(folded, ["a", "b"], settings=SMALL)
    assert len(events) == 9 and "Exchange" not in together._jdf.queryExecution().executedPlan().toString()
    events.clear()
    monkeypatch.setattr(m, "ROWS_SIDE_BY_SIDE", 59)
    apart = m.cross_validate(folded, ["a", "b"], settings=SMALL)
    assert events == ["fit", "fitted", "fold-cells"] * 3
    assert sorted(apart.collect()) == sorted(together.collect())


def test_statistics_of_nodes_fit_an_executor():
    """Each core of an executor holds the statistics of one group of nodes."""
    assert 4 * m.forest(["a"]).getStages()[1].getMaxMemoryInMB() <= 2048


def test_cross_validation_trains_without_the_held_out_fold(table):
    """A forest that memorises random labels does so only on its training side."""
    noise = table.withColumn(TARGET, (F.hash("id") % 2 == 0).cast("int"))
    folded = assign_folds(noise, ["id"], TARGET)
    scores = {(r.fold, r.split): r.value for r in m.cross_validate(folded, ["b"], settings=m.ForestSettings(20, 15)).where("metric = 'accuracy'").collect()}
    assert min(v for (_, s), v in scores.items() if s == "train") > 0.85
    assert sum(v for (_, s), v in scores.items() if s == "test") / 3 < 0.75


def test_stages_from_csv_to_drift(spark, tmp_path):
    root, csv = str(tmp_path / "root"), str(tmp_path / "csv")
    star.raw(spark, "/root/testdata/sf0.001").write.option("header", True).csv(csv)
    live, log, requests = (str(tmp_path / n) for n in ("live", "log", "requests"))
    records = star.addr_dirty(spark, "/root/testdata/sf0.001").select(F.current_timestamp().alias("timestamp"), "income", "neighbors", "weight")
    tables.write_live_json(records, live)
    star.event_log(spark, "/root/testdata/sf0.001").select(*[F.col(f.name).cast(f.dataType) for f in PREDICTION_LOG]).write.parquet(log)
    star.requests(spark, "/root/testdata/sf0.001").select("body").write.text(requests)
    everything = [x for s in jobs.STAGES for x in ("--stage", s)]
    given = ["--csv", csv, "--live", live, "--requests", requests, "--log", log, "--once"]
    jobs.main(["--root", root, *given, "--trees", "3", "--depth", "4", *everything])
    at = stages.Layout(root)
    features = tables.read_table(spark, at.at("features"))
    assert set(features.columns) == {TARGET, *FEATURE_COLUMNS}
    found = tables.read_table(spark, at.at("drift")).collect()
    assert {r.feature for r in found} == {"income", "neighbors", "weight"}
    assert all(0 <= r.psi < 0.5 for r in found)
    run = tables.load_runs(spark, at.at("run-log")).collect()[0]
    assert all(run.run_id in run[p] for p in ("model_path", "state_path", "columns_path", "profile_path"))
    done = [spark.read.parquet(at.at(n)).count() for n in ("scored", "rejected")]
    assert sum(done) == spark.read.text(requests).count() and min(done) > 0
    counted = sinks.latest(spark, at.at("request-windows"), monitor.windowed_requests(spark.read.parquet(log)).schema, ["window_start", "window_end"])
    assert counted.agg(F.sum("requests")).first()[0] == spark.read.parquet(log).count()
    # A stream started again goes on where it was: nothing comes twice.
    jobs.main(["--root", root, "--stage", "score", "--requests", requests, "--once"])
    assert spark.read.parquet(at.at("scored")).count() == done[0]
    # A stage run again replaces its table.
    jobs.main(["--root", root, "--stage", "preprocess"])
    assert tables.read_table(spark, at.at("preprocessed")).count() == features.count()


def test_ingest_needs_a_csv(tmp_path):
    with pytest.raises(SystemExit):
        jobs.main(["--root", str(tmp_path), "--stage", "ingest"])
