"""Fit, cross-validate and apply the random forest, as a saved Spark ML pipeline."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from riskloom.operators.features import align
from riskloom.operators.forest import MAX_BINS, grow_forest
from riskloom.operators.metrics import classification_report, confusion, roc_auc, scores_of, summarise_folds, test_summary
from riskloom.operators.sampling import assign_folds, stratified_split
from riskloom.schemas import (
    DECISION_THRESHOLD, MAX_DEPTH, NEGATIVE_NAME, NUM_FOLDS, NUM_TREES, POSITIVE_NAME, SEED, TARGET, TEST_FRACTION,
)
from riskloom.session import at_rest


# A cross-validation fits its folds side by side up to this many rows; each fit over more fills a cluster, and its memory, alone.
ROWS_SIDE_BY_SIDE = 1_000_000
# Training rows of one task. Spark keeps them in memory at some 600 bytes a row (20 trees) and reads them once per pass.
ROWS_PER_TASK = 500_000
# Over more training rows the forest is grown by ``forest.grow_forest``: its deep nodes go with the rows.
ROWS_OF_CLASSIFIER = 250_000


@dataclass(frozen=True)
class ForestSettings:
    trees: int = NUM_TREES
    depth: int = MAX_DEPTH
    seed: int = SEED
    # Bins per feature when looking for splits.
    max_bins: int = 128
    # Memory for the statistics of the tree nodes grown in one pass over the data. Deep
    # trees have many nodes, and each group of nodes that does not fit costs a pass.
    # Every running task holds that much, so an executor holds it once per core.
    node_memory_mb: int = 512


def forest(columns: Sequence[str], settings: ForestSettings = ForestSettings()) -> Pipeline:
    """Assembler, which carries the ordered column contract, and classifier."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="features"),
        RandomForestClassifier(
            labelCol=TARGET, featuresCol="features", numTrees=settings.trees, maxDepth=settings.depth,
            seed=settings.seed, maxBins=settings.max_bins, maxMemoryInMB=settings.node_memory_mb,
            # Node ids are kept per row, so that deep trees are not walked again for every level.
            cacheNodeIds=True, checkpointInterval=10,
        ),
    ])


def contract(model: PipelineModel) -> list[str]:
    """The model's input columns in order, as saved with it."""
    return model.stages[0].getInputCols()


def spread(table: DataFrame, rows: int) -> DataFrame:
    """``table`` in so many partitions that none holds many more than ``ROWS_PER_TASK`` rows; one that already is stays as it is."""
    parts = math.ceil(rows / ROWS_PER_TASK)
    return table.repartition(parts) if parts > table.rdd.getNumPartitions() else table


def fit(table: DataFrame, columns: Sequence[str], settings: ForestSettings = ForestSettings()) -> PipelineModel:
    """Fit a forest. ``table`` should be at rest: its rows are counted first, as what a task holds must not grow with the table.

    Many rows of two classes are grown node by node where their rows are; a few rows, or another label, go to Spark's classifier.
    """
    if TARGET not in table.columns:
        raise ValueError(f"Column '{TARGET}' is needed to fit the model.")
    rows = align(table, columns, keep=[TARGET])
    sizes = {r[TARGET]: r["count"] for r in rows.groupBy(TARGET).count().limit(3).collect()}
    training = spread(rows, table.count() if len(sizes) > 2 else sum(sizes.values()))
    if set(sizes) == {0, 1} and sum(sizes.values()) > ROWS_OF_CLASSIFIER and settings.max_bins <= MAX_BINS:
        assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
        assembled = assembler.transform(training).select(F.col(TARGET).alias("label"), "features")
        return PipelineModel([assembler, grow_forest(assembled, settings.trees, settings.depth, settings.max_bins, settings.seed)])
    return forest(columns, settings).fit(training)


def score(model: PipelineModel, table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` plus ``probability`` of the positive class and the ``prediction`` it means."""
    aligned = align(table, contract(model), keep=keep)
    scored = model.transform(aligned).select(
        *keep, vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("pred")
    )
    named = F.when(F.col("probability") >= DECISION_THRESHOLD, POSITIVE_NAME).otherwise(NEGATIVE_NAME)
    return scored.withColumn("prediction", named)


def cross_validate(
    folded: DataFrame, columns: Sequence[str], folds: int = NUM_FOLDS, settings: ForestSettings = ForestSettings(),
    parallelism: int = NUM_FOLDS,
) -> DataFrame:
    """Fit once per fold and score its two sides: rows (fold, split, metric, value).

    Up to ``parallelism`` fits are submitted to the cluster at a time, over many rows one. A fold's counts are written as
    soon as its model is there: no model outlives its fold, and no task holds those of several.
    """

    def counted(k: int) -> DataFrame:
        model = fit(folded.where(F.col("fold") != k), columns, settings)
        side = F.when(F.col("fold") == k, "test").otherwise("train").alias("split")
        scored = score(model, folded, keep=[TARGET, "fold"]).select(F.lit(k).alias("round"), side, TARGET, "pred")
        return at_rest(confusion(scored, ["round", "split"], label=TARGET), "fold-cells")

    at_once = min(parallelism, folds) if folded.count() <= ROWS_SIDE_BY_SIDE else 1
    with ThreadPool(at_once) as pool:
        parts = pool.map(inheritable_thread_target(folded.sparkSession)(counted), range(folds))
    cells = reduce(DataFrame.unionByName, parts)
    return scores_of(cells, ["round", "split"]).withColumnRenamed("round", "fold")


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    fold_scores: DataFrame
    report: DataFrame
    auc: DataFrame
    summary: DataFrame


def evaluate(model: PipelineModel, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classification report and AUC on held-out rows, which are scored once."""
    if TARGET not in test.columns:
        raise ValueError(f"Column '{TARGET}' is needed to evaluate the model.")
    scored = at_rest(score(model, test, keep=[TARGET]), "scored")
    return (
        classification_report(confusion(scored, label=TARGET)),
        roc_auc(scored, label=TARGET, score="probability"),
    )


def train(
    table: DataFrame, columns: Sequence[str], key: Sequence[str], settings: ForestSettings = ForestSettings(),
    test_fraction: float = TEST_FRACTION, folds: int = NUM_FOLDS, seed: int = SEED,
) -> Trained:
    """Split, cross-validate on the training side, fit on it, evaluate on the test side."""
    split = at_rest(stratified_split(table, key, TARGET, test_fraction, seed), "split")
    training = split.where("split = 'train'").drop("split")
    folded = at_rest(assign_folds(training, key, TARGET, folds, seed), "folds")
    fold_scores = at_rest(cross_validate(folded, columns, folds, settings), "fold-scores")
    model = fit(folded, columns, settings)
    report, auc = evaluate(model, split.where("split = 'test'"))
    return Trained(model, fold_scores, report, auc, test_summary(report, auc, summarise_folds(fold_scores)))
