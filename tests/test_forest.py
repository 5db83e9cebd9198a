"""Forests over many rows: splits, bins, leaves and the whole fit, against numpy and Spark's classifier."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import forest, model as m
from riskloom.schemas import TARGET
from riskloom.session import at_rest
from riskloom.sources import tables

BINS = 16


def impurity(zeros, ones):
    return zeros * ones / max(zeros + ones, 1)


def least(counts):
    """The least impurity of a cut that leaves rows on both sides, by trying all."""
    found = [np.inf]
    for cut in range(counts.shape[1] - 1):
        left, right = counts[:, :cut + 1].sum(axis=1), counts[:, cut + 1:].sum(axis=1)
        if left.sum() and right.sum():
            found.append(impurity(*left) + impurity(*right))
    return min(found)


def test_best_cuts_by_trying_all():
    counts = np.random.default_rng(1).poisson(0.7, (200, 2, 8)).astype(float)
    found, at = forest.best_cuts(counts)
    assert found.tolist() == pytest.approx([least(c) for c in counts])
    for c, value, cut in zip(counts, found, at):
        if np.isfinite(value):
            assert impurity(*c[:, :cut + 1].sum(axis=1)) + impurity(*c[:, cut + 1:].sum(axis=1)) == pytest.approx(value)


def noisy(n=3000, features=5, seed=3):
    random = np.random.default_rng(seed)
    bins = random.integers(0, BINS, (n, features)).astype(np.uint8)
    ones = ((bins[:, 0] > 7) ^ (random.random(n) < 0.1)).astype(np.uint8)
    return bins, ones, random.poisson(1.0, n).astype(np.uint8)


def leaves_hold_their_rows(tree, bins, ones, drawn):
    """Shares of the leaves are those of the drawn rows that come to them, and every inner node has rows on both sides."""
    leaf = forest._reached(tree, bins)
    rows = np.bincount(leaf, drawn, len(tree.feature))
    positive = np.bincount(leaf, drawn * ones.astype(float), len(tree.feature))
    at = tree.feature < 0
    assert (rows[at] > 0).all() and (rows[~at] == 0).all()
    assert tree.share[at].tolist() == pytest.approx((positive[at] / rows[at]).tolist())
    return leaf


def depth_of(tree, node=0):
    return 0 if tree.feature[node] < 0 else 1 + max(depth_of(tree, tree.left[node] + i) for i in (0, 1))


@pytest.mark.parametrize("depth", [1, 4, 20])
def test_tree_in_memory(depth):
    bins, ones, drawn = noisy()
    kept = drawn > 0
    bins, ones, drawn = bins[kept], ones[kept], drawn[kept]
    tree = forest.grow(bins, ones, drawn, depth, BINS, 5, np.random.default_rng(1))
    leaves_hold_their_rows(tree, bins, ones, drawn)
    assert depth_of(tree) <= depth
    root = [least(np.stack([np.bincount(bins[ones == y, f], drawn[ones == y], BINS) for y in (0, 1)])) for f in range(5)]
    assert tree.feature[0] == np.argmin(root) == 0 and tree.cut[0] == 7
    if depth == 20:
        assert np.isin(tree.share[tree.feature < 0], (0, 1)).mean() > 0.95
    small = forest.pruned(tree)
    reached = [t.share[forest._reached(t, bins)] > 0.5 for t in (tree, small)]
    assert reached[0].tolist() == reached[1].tolist() and len(small.feature) <= len(tree.feature)
    leaves_hold_their_rows(small, bins, ones, drawn)
    for node in np.flatnonzero(small.feature >= 0):
        a, b = small.left[node], small.left[node] + 1
        assert max(small.feature[a], small.feature[b]) >= 0 or (small.share[a] > 0.5) != (small.share[b] > 0.5)


@pytest.fixture(scope="module")
def table(spark):
    """6000 rows whose label two of four features decide, wrong on 1 of 20; one feature has three values."""
    a, b = F.rand(1) * 100, F.rand(2) * 100
    rows = spark.range(6000).select("id", a.alias("a"), b.alias("b"), F.rand(3).alias("c"), (F.col("id") % 3).cast("double").alias("d"))
    wrong = F.pmod(F.xxhash64("id"), F.lit(20)) == 0
    labelled = rows.withColumn("truth", ((F.col("a") > 40) & (F.col("b") > 30)).cast("int"))
    return at_rest(labelled.withColumn(TARGET, F.when(wrong, 1 - F.col("truth")).otherwise(F.col("truth"))).repartition(3), "rows")


def test_bins_of_all_rows(spark, table):
    rows = table.select(F.lit(0.0).alias("label"), F.array("a", "d", F.lit(7.0)).alias("features"))
    a, d, same = forest.bin_limits(rows, 128)
    assert d.tolist() == [0.5, 1.5] and same.tolist() == []
    values = np.sort(np.array([r.a for r in table.select("a").collect()]))
    assert len(a) == 127 and (np.diff(a) > 0).all()
    assert np.abs(np.searchsorted(values, a) / 6000 - np.arange(1, 128) / 128).max() < 0.002


@pytest.mark.parametrize("most", [10**6, 900, 60])
def test_rows_of_large_and_small_nodes(spark, table, monkeypatch, most):
    """Wherever growing goes over from histograms to single tasks, every drawn row comes to one leaf and counts there."""
    monkeypatch.setattr(forest, "ROWS_PER_SUBTREE", most)
    rows = table.select(F.col(TARGET).cast("double").alias("label"), F.array("a", "b", "c", "d").alias("features"))
    blocks = at_rest(forest.dealt(rows, forest.bin_limits(rows, 32), 4, 42), "blocks")
    held = [{c: np.frombuffer(v, np.uint8) for c, v in r.asDict().items()} for r in blocks.collect()]
    bins, ones = np.concatenate([b["bins"].reshape(-1, 4) for b in held]), np.concatenate([b["ones"] for b in held])
    drawn = np.concatenate([b["drawn"].reshape(4, -1) for b in held], axis=1)
    assert len(ones) == 6000 and 0.95 < drawn.mean() < 1.05
    for t, tree in enumerate(forest._grown(blocks, 4, 8, 32, 42, 4)):
        some = drawn[t] > 0
        leaves_hold_their_rows(tree, bins[some], ones[some], drawn[t][some])
        assert 1 <= depth_of(tree) <= 8


def test_many_rows_are_not_left_to_the_classifier(spark, table, tmp_path, monkeypatch):
    """Over the bound no classifier is fitted, the forest learns the truth behind the wrong labels, and is the same when read again."""
    columns, settings = ["a", "b", "c", "d"], m.ForestSettings(trees=10, depth=8)
    plain = m.score(m.fit(table, columns, settings), table, ["id", "truth"])
    monkeypatch.setattr(m, "ROWS_OF_CLASSIFIER", 5999, raising=False)
    monkeypatch.setattr(m, "forest", lambda *_: pytest.fail("the classifier was asked"))
    model = m.fit(table, columns, settings)
    assert m.contract(model) == columns
    found = m.score(model, table, ["id", "truth"])
    assert found.dtypes == plain.dtypes
    right = [df.where("pred = truth").count() / 6000 for df in (found, plain)]
    assert min(right) > 0.97 and abs(right[0] - right[1]) < 0.01
    assert found.where("(probability > 0.5) <> (pred = 1) OR probability NOT BETWEEN 0 AND 1").isEmpty()
    tables.save_model(model, str(tmp_path / "m"))
    again = tables.load_model(str(tmp_path / "m"))
    assert m.contract(again) == columns
    assert sorted(m.score(again, table, ["id", "truth"]).collect()) == sorted(found.collect())
    assert sorted(m.score(m.fit(table, columns, settings), table, ["id", "truth"]).collect()) == sorted(found.collect())
    assert m.score(model, table.limit(0), ["id"]).collect() == []


def test_other_labels_go_to_the_classifier(table, monkeypatch):
    monkeypatch.setattr(m, "ROWS_OF_CLASSIFIER", 0, raising=False)
    three = table.withColumn(TARGET, F.col("d").cast("int"))
    fitted = m.fit(three, ["a", "d"], m.ForestSettings(trees=2, depth=2))
    assert fitted.stages[1].numClasses == 3
