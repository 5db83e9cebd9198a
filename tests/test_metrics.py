import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from riskloom.operators import metrics as m


def predictions(spark, pairs):
    return spark.createDataFrame(pairs, "y int, pred int")


def report_of(spark, pairs):
    rows = m.classification_report(m.confusion(predictions(spark, pairs))).collect()
    return {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in rows}


def test_report(spark):
    pairs = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 3 + [(0, 0)] * 9
    got = report_of(spark, pairs)
    p1, r1, p0, r0 = 6 / 9, 6 / 8, 9 / 11, 9 / 12
    f1, f0 = 2 * p1 * r1 / (p1 + r1), 2 * p0 * r0 / (p0 + r0)
    assert got["1"] == pytest.approx((p1, r1, f1, 8))
    assert got["0"] == pytest.approx((p0, r0, f0, 12))
    assert got["accuracy"] == pytest.approx((0.75, 0.75, 0.75, 20))
    assert got["macro avg"] == pytest.approx(((p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, 20))
    assert got["weighted avg"][2] == pytest.approx((12 * f0 + 8 * f1) / 20)


def test_zero_divisions_count_as_zero(spark):
    got = report_of(spark, [(1, 0)] * 2 + [(0, 0)] * 2)
    assert got["1"] == (0.0, 0.0, 0.0, 2)
    assert got["0"] == pytest.approx((0.5, 1.0, 2 / 3, 2))


def test_unseen_class_is_not_listed(spark):
    got = report_of(spark, [(0, 0)] * 3)
    assert "1" not in got and got["macro avg"][:3] == (1.0, 1.0, 1.0)


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9).map(lambda v: v / 10)), min_size=1, max_size=60))
def test_auc_equals_brute_force(spark, rows):
    expected = brute_auc(rows)
    got = m.roc_auc(spark.createDataFrame(rows, "y int, score double")).first()[0]
    assert got == (None if expected is None else pytest.approx(expected))


def test_auc_over_many_scores_equals_the_evaluator(spark):
    rng = np.random.default_rng(5)
    rows = [(int(y), float(s)) for y, s in zip(rng.integers(0, 2, 4000), rng.random(4000))]
    # A third of all rows share one score.
    rows += [(int(y), 0.5) for y in rng.integers(0, 2, 2000)]
    df = spark.createDataFrame(rows, "y int, score double")
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    assert m.roc_auc(df).first()[0] == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_fold_summary_uses_population_deviation(spark):
    rows = [(k, "test", "f1", v) for k, v in enumerate((0.5, 0.6, 0.7))]
    got = m.summarise_folds(spark.createDataFrame(rows, "fold int, split string, metric string, value double")).first()
    assert (got["mean"], got["std"]) == pytest.approx((0.6, np.std([0.5, 0.6, 0.7])))


def test_summary_without_positive_class(spark):
    report = m.classification_report(m.confusion(predictions(spark, [(0, 0)])))
    auc = spark.createDataFrame([(0.9,)], "roc_auc double")
    folds = spark.createDataFrame([("test", "f1", 0.8, 0.1)], "split string, metric string, mean double, std double")
    assert tuple(m.test_summary(report, auc, folds).first()) == (1.0, 0.9, None, 0.8, 0.1)


LOG = "ts timestamp, is_error int, prediction string, latency_seconds double"


def test_request_counters(spark):
    rows = [(None, 0, "clean", 0.1), (None, 1, None, 0.2), (None, 0, "ransomware", 20.0), (None, 0, "clean", 0.1)]
    log = spark.createDataFrame(rows, LOG)
    got = {(r.metric, r.label): r.value for r in m.request_counters(log).collect()}
    assert got == {
        ("prediction_requests", ""): 4, ("prediction_errors", ""): 1,
        ("prediction_labels", "ransomware"): 1, ("prediction_labels", "clean"): 2,
    }


def test_latency_is_cumulative_and_counts_errors(spark):
    log = spark.createDataFrame([(None, 0, "clean", 0.1), (None, 1, None, 0.3), (None, 0, "clean", 20.0)], LOG)
    got = {r.le: r.cumulative_count for r in m.latency_histogram(log).collect()}
    assert got["0.075"] == 0 and got["0.1"] == 1 and got["0.5"] == 2 and got["10.0"] == 2 and got["+Inf"] == 3
    row = m.latency_histogram(log).first()
    assert row.observations == 3 and math.isclose(row.total_seconds, 20.4)


def test_auc_leaves_out_rows_without_a_score(spark):
    rows = [(1, 0.9), (0, 0.1), (1, float("nan")), (0, None)]
    assert m.roc_auc(spark.createDataFrame(rows, "y int, score double")).first()[0] == 1.0
