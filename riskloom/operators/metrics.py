"""Classifier metrics and request metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schemas import LATENCY_BOUNDS, NEGATIVE_NAME, POSITIVE_NAME

CV_METRICS = ["accuracy", "precision", "recall", "f1"]


def _share(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where the divisor is zero."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _share(2 * precision * recall, precision + recall)


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "y", predicted: str = "pred") -> DataFrame:
    """The four cells of the 0/1 confusion table, one row per group."""
    y, p = F.col(label), F.col(predicted)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def classification_report(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per-class, accuracy and average rows from confusion cells.

    A class is listed when it occurs among labels or predictions.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = tp + fp + fn + tn

    def of_class(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        precision, recall = _share(hit, hit + false_hit), _share(hit, hit + miss)
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            _f1(precision, recall).alias("f1"), (hit + miss).alias("support"),
            (hit + false_hit + miss > 0).alias("seen"),
        )

    listed = cells.withColumn("rows", rows).withColumn(
        "classes", F.filter(F.array(of_class("0", tn, fn, fp), of_class("1", tp, fp, fn)), lambda c: c["seen"])
    )
    measures = ["precision", "recall", "f1"]
    accuracy = _share(tp + tn, F.col("rows"))

    def mean(measure: str, weight: Column | None = None) -> Column:
        def add(acc: Column, c: Column) -> Column:
            return acc + (c[measure] if weight is None else c[measure] * c["support"])
        summed = F.aggregate("classes", F.lit(0.0), add)
        return _share(summed, F.size("classes") if weight is None else weight)

    def average(name: str, values: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(m) for m, v in zip(measures, values)],
            F.col("rows").alias("support"), F.lit(True).alias("seen"),
        )

    extra = F.array(
        average("accuracy", [accuracy] * 3),
        average("macro avg", [mean(m) for m in measures]),
        average("weighted avg", [mean(m, F.col("rows")) for m in measures]),
    )
    return listed.select(*by, F.inline(F.concat("classes", extra))).drop("seen")


def scores_of(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the positive class's precision, recall and F1, as (metric, value) rows."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)
    values = [_share(tp + tn, tp + fp + fn + tn), precision, recall, _f1(precision, recall)]
    pairs = [F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in zip(CV_METRICS, values)]
    return cells.select(*by, F.inline(F.array(*pairs)))


def summarise_folds(fold_scores: DataFrame) -> DataFrame:
    """Mean and population deviation over folds per (split, metric)."""
    return fold_scores.groupBy("split", "metric").agg(
        F.mean("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def roc_auc(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """Area under the ROC curve, ties counted half; one row, null with a single class.

    Rows are first summed per distinct score. The running count of negatives is then
    taken inside ranges between quantiles, so none holds many more distinct scores than
    its share of the rows, and the ranges are put together from their totals. No task
    sorts all scores. The input is read twice, so it should be a table at rest. Rows without a score
    (null or NaN) rank nowhere and are left out.
    """
    y = F.col(label)
    df = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    per_score = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(y == 1).cast("double").alias("pos"), F.count_if(y == 0).cast("double").alias("neg")
    )
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / ranges for i in range(1, ranges)] or [0.5]
    inner = sorted(set(df.select(F.col(score).cast("double").alias("s")).approxQuantile("s", steps, 0.5 / ranges)))
    splits = [float("-inf"), *inner, float("inf")]
    ranged = (
        Bucketizer(splits=splits, inputCol="s", outputCol="range").transform(per_score)
        if inner else per_score.withColumn("range", F.lit(0.0))
    )
    inside = Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    # Within a range: pairs won or tied; across ranges: every earlier negative is below every positive.
    part = (
        ranged.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0.0)))
        .groupBy("range")
        .agg(
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("won"),
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        )
    )
    # One row per range, no more than the shuffle width.
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        part.withColumn("earlier", F.coalesce(F.sum("neg").over(across), F.lit(0.0)))
        .agg(
            F.try_divide(
                F.sum(F.col("won") + F.col("pos") * F.col("earlier")), F.sum("pos") * F.sum("neg")
            ).alias("roc_auc")
        )
    )


def test_summary(report: DataFrame, auc: DataFrame, folds: DataFrame) -> DataFrame:
    """One row: accuracy, AUC, F1 of the positive class, and cross-validated test F1.

    All inputs are a few rows; they are gathered as (name, value) pairs and pivoted by aggregate.
    """
    held_out = (F.col("split") == "test") & (F.col("metric") == "f1")
    pairs = (
        report.where(F.col("class").isin("accuracy", "1"))
        .select(F.when(F.col("class") == "1", "f1_positive").otherwise("accuracy").alias("name"), F.col("f1").alias("value"))
        .unionByName(auc.select(F.lit("roc_auc").alias("name"), F.col("roc_auc").alias("value")))
        .unionByName(folds.where(held_out).select(F.inline(F.array(
            F.struct(F.lit("cv_test_f1_mean").alias("name"), F.col("mean").alias("value")),
            F.struct(F.lit("cv_test_f1_std").alias("name"), F.col("std").alias("value")),
        ))))
    )
    names = ["accuracy", "roc_auc", "f1_positive", "cv_test_f1_mean", "cv_test_f1_std"]
    return pairs.agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


test_summary.__test__ = False  # an operator, not a test case


def request_aggregates() -> list[Column]:
    """Requests, errors and successes per label, to be used in any grouping."""
    failed = F.col("is_error") == 1
    return [
        F.count("*").alias("requests"),
        F.count_if(failed).alias("errors"),
        *[F.count_if(~failed & (F.col("prediction") == p)).alias(p) for p in (POSITIVE_NAME, NEGATIVE_NAME)],
    ]


def request_counters(log: DataFrame) -> DataFrame:
    """Counter rows (metric, label, value); every request counts, labels only for successes."""
    rows = [
        ("prediction_requests", "", "requests"),
        ("prediction_errors", "", "errors"),
        ("prediction_labels", POSITIVE_NAME, POSITIVE_NAME),
        ("prediction_labels", NEGATIVE_NAME, NEGATIVE_NAME),
    ]
    structs = [
        F.struct(F.lit(m).alias("metric"), F.lit(lab).alias("label"), F.col(c).alias("value")) for m, lab, c in rows
    ]
    return log.agg(*request_aggregates()).select(F.inline(F.array(*structs)))


def latency_aggregates() -> list[Column]:
    """Cumulative counts per bound, plus total count and sum: fixed-width partial sums."""
    x = F.col("latency_seconds")
    return [
        F.array(*[F.count_if(x <= b) for b in LATENCY_BOUNDS], F.count(x)).alias("counts"),
        F.count(x).alias("observations"),
        F.sum(x).alias("total_seconds"),
    ]


def latency_rows(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per bucket from the wide aggregate."""
    bounds = F.array(*[F.lit(str(b)) for b in LATENCY_BOUNDS], F.lit("+Inf"))
    cells = F.transform(
        F.arrays_zip(bounds.alias("le"), F.col("counts").alias("n")),
        lambda c: F.struct(c["le"].alias("le"), c["n"].alias("cumulative_count")),
    )
    return wide.select(*by, F.inline(cells), "observations", "total_seconds").select(
        *by, "le", "cumulative_count", "observations", "total_seconds"
    )


def latency_histogram(log: DataFrame) -> DataFrame:
    return latency_rows(log.agg(*latency_aggregates()))
