"""A random forest over many rows: large nodes are split by histograms from all tasks, smaller ones grow whole in one task each.

Spark's classifier sends the statistics of every node, all bins of them, from every partition. A deep forest on a label
that is partly wrong has nodes in proportion to its rows, nearly all of them small, so that is what its time goes into. Here the
rows are binned and drawn once per tree and lie at rest in blocks. Nodes of more than ``ROWS_PER_SUBTREE`` drawn rows are split
level by level, all trees in one pass. Then the drawn rows of every other node come together in one task, which
grows it down to the leaves. The rules are Spark's: gini gain, square root of the features at each node, at most ``max_bins``
bins a feature, Poisson draws with replacement, leaves of one answer merged, mean of the trees' leaf shares. Random numbers
differ, so single trees do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import new_path, remove

# Drawn rows of a node that one task grows whole, in some 150 MB.
ROWS_PER_SUBTREE = 1_000_000
# Rows of a block, and values kept of a feature when its bins are looked for.
BLOCK, POINTS = 65_536, 4096
# Nodes whose histograms a task holds in one pass (10 KB each with 5 features of 128 bins), and whose splits are tried together.
NODES_PER_PASS, NODES_TOGETHER = 2048, 512
MAX_BINS = 256

BLOCKS = "bins binary, ones binary, drawn binary"
PIECES = "subtree long, bins binary, ones binary, drawn binary"
SPLITS = "slot long, tried int, cut int, l0 double, l1 double, r0 double, r1 double"
NODES = ("feature", "cut", "left", "share")
KINDS = (np.int16, np.uint8, np.int32, np.float64)


class Tree(NamedTuple):
    """Nodes by number, the root first. Of an inner node: the feature, the last bin that goes left, and the left child, which the
    right one follows; of a leaf the feature is -1. ``share`` is that of the positive rows in a node."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    share: np.ndarray


def thinned(values: np.ndarray, counts: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their rows; of more than ``points`` those at equal steps of rank, each with the rows since the last one."""
    found, at = np.unique(values, return_inverse=True)
    rows = np.bincount(at.reshape(-1), counts, len(found))
    if len(found) <= points:
        return found, rows
    upto = rows.cumsum()
    steps = np.searchsorted(upto, upto[-1] * np.arange(1, points + 1) / points)
    steps = np.unique(np.minimum(steps, len(found) - 1))
    return found[steps], np.diff(upto[steps], prepend=0)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and features of about ``BLOCK`` rows at a time."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column("label").to_numpy(zero_copy_only=False), _matrix(batch.column("features"))))
        if sum(len(y) for y, _ in held) >= BLOCK:
            yield np.concatenate([y for y, _ in held]), np.concatenate([x for _, x in held])
            held = []
    if held:
        yield np.concatenate([y for y, _ in held]), np.concatenate([x for _, x in held])


def bin_limits(rows: DataFrame, max_bins: int) -> list[np.ndarray]:
    """Ascending limits per feature; a value belongs to the first bin whose limit it does not exceed, or to the last one.

    Up to ``max_bins`` values get a bin each, more of them are cut at equal steps of rank. All rows are read.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for _, x in _together(batches):
            for f in range(x.shape[1]):
                v, c = kept.get(f, (x[:0, f], np.zeros(0)))
                kept[f] = thinned(np.concatenate([v, x[:, f]]), np.concatenate([c, np.ones(len(x))]), POINTS)
        if kept:
            columns = [list(kept), [v.tobytes() for v, _ in kept.values()], [c.tobytes() for _, c in kept.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["feature", "values", "counts"])

    def limits(found: pa.Table) -> pa.Table:
        v, c = (np.frombuffer(b"".join(found[name].to_pylist()), np.float64) for name in ("values", "counts"))
        v, c = thinned(v, c, 2**62)
        if len(v) <= max_bins:
            between = v[:-1] / 2 + v[1:] / 2
            cuts = np.where(np.isfinite(between), between, v[:-1])
        else:
            cuts = thinned(v, c, max_bins)[0][:-1]
        return pa.table({"feature": found["feature"][:1], "limits": pa.array([cuts.tobytes()], pa.binary())})

    sketched = rows.mapInArrow(sketch, "feature long, values binary, counts binary")
    found = sketched.groupBy("feature").applyInArrow(limits, "feature long, limits binary").collect()
    return [np.frombuffer(r["limits"], np.float64) for r in sorted(found, key=lambda r: r["feature"])]


def dealt(rows: DataFrame, limits: Sequence[np.ndarray], trees: int, seed: int) -> DataFrame:
    """Blocks of rows: their bins, labels, and how often each tree draws them."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for i, (y, x) in enumerate(_together(batches)):
            bins = np.stack([np.searchsorted(limits[f], x[:, f]) for f in range(x.shape[1])], axis=1).astype(np.uint8)
            drawn = np.random.default_rng([seed, part, i]).poisson(1.0, (trees, len(y))).astype(np.uint8)
            block = [bins.tobytes(), y.astype(np.uint8).tobytes(), drawn.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in block], ["bins", "ones", "drawn"])

    return rows.mapInArrow(step, BLOCKS)


def best_cuts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of counts (node, class, bin): the least impurity that a cut leaves, times rows, and the last bin left of it."""
    left = counts.cumsum(axis=2)
    right = left[:, :, -1:] - left
    n_left, n_right = left.sum(axis=1), right.sum(axis=1)
    impurity = left[:, 0] * left[:, 1] / np.maximum(n_left, 1) + right[:, 0] * right[:, 1] / np.maximum(n_right, 1)
    impurity[(n_left == 0) | (n_right == 0)] = np.inf
    at = impurity.argmin(axis=1)
    return impurity[np.arange(len(at)), at], at


def gains(before: np.ndarray, impurity: np.ndarray) -> np.ndarray:
    """Whether nodes with rows ``before`` (node, class) are purer after their cuts, rounding apart."""
    return impurity < before.prod(axis=1) / before.sum(axis=1) * (1 - 1e-9)


def tried_features(random: np.random.Generator, nodes: int, features: int, tried: int) -> np.ndarray:
    """For each node ``tried`` features, drawn without replacement."""
    return random.random((nodes, features)).argsort(axis=1)[:, :tried]


def grow(bins: np.ndarray, ones: np.ndarray, drawn: np.ndarray, depth: int, max_bins: int, width: int, random: np.random.Generator) -> Tree:
    """A tree of at most ``depth`` levels below its root on rows in memory, level by level. Rows of a node lie together in ``row``."""
    n, d = bins.shape
    flat, ones, drawn = bins.reshape(-1), ones.astype(np.int64), drawn.astype(np.float64)
    row, starts, first, levels = np.arange(n), np.array([0, n]), 0, []
    for level in range(depth + 1):
        m = len(starts) - 1
        node = np.repeat(np.arange(m), np.diff(starts))
        rows = np.bincount(2 * node + ones[row], drawn[row], 2 * m).reshape(m, 2)
        feature, cut, left = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.zeros(m, np.int32)
        levels.append((feature, cut, left, rows[:, 1] / rows.sum(axis=1)))
        open_ = rows.min(axis=1) > 0
        if level == depth or not open_.any():
            break
        row, node, starts = _only(open_, row, node, starts)
        rows = rows[open_]
        tried = tried_features(random, len(rows), d, width)
        chosen, cuts, impurity = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.full(len(rows), np.inf)
        for a in range(0, len(rows), NODES_TOGETHER):
            z = min(a + NODES_TOGETHER, len(rows))
            r, own = row[starts[a]:starts[z]], node[starts[a]:starts[z]]
            key, weight, cells = (2 * (own - a) + ones[r]) * max_bins, drawn[r], r * d
            for j in range(width):
                f = tried[a:z, j]
                counts = np.bincount(key + flat[cells + f[own - a]], weight, 2 * (z - a) * max_bins)
                least, at = best_cuts(counts.reshape(z - a, 2, max_bins))
                better = least < impurity[a:z]
                chosen[a:z][better], cuts[a:z][better], impurity[a:z][better] = f[better], at[better], least[better]
        split = gains(rows, impurity)
        if not split.any():
            break
        inner = np.flatnonzero(open_)[split]
        first += m
        feature[inner], cut[inner], left[inner] = chosen[split], cuts[split], first + 2 * np.arange(len(inner))
        row, node, starts = _only(split, row, node, starts)
        goes_left = flat[row * d + chosen[split][node]] <= cuts[split][node]
        row, starts = _parted(goes_left, row, node, starts)
    return Tree(*[np.concatenate(column) for column in zip(*levels)])


def _only(kept: np.ndarray, row: np.ndarray, node: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of some nodes, which are numbered anew."""
    sizes = np.diff(starts)[kept]
    return row[kept[node]], np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], sizes.cumsum()])


def _parted(goes_left: np.ndarray, row: np.ndarray, node: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each node with those that go left before the others, and where the two children's rows start."""
    upto = goes_left.cumsum()
    before = np.concatenate([[0], upto])[starts]
    lefts, rank = np.diff(before), upto - before[node]
    place = np.where(goes_left, starts[node] + rank - 1, np.arange(len(row)) + lefts[node] - rank)
    moved = np.empty_like(row)
    moved[place] = row
    children = np.empty(2 * len(lefts) + 1, np.int64)
    children[0:-1:2], children[1::2], children[-1] = starts[:-1], starts[:-1] + lefts, starts[-1]
    return moved, children


def pruned(tree: Tree) -> Tree:
    """Without splits into two leaves of the same answer, as Spark prunes; nodes that are left are numbered anew."""
    feature, levels = tree.feature.copy(), [np.zeros(1, np.int64)]
    while len(inner := levels[-1][feature[levels[-1]] >= 0]):
        levels.append(np.stack([tree.left[inner], tree.left[inner] + 1], axis=1).reshape(-1).astype(np.int64))
    answer = tree.share > 0.5
    for level in reversed(levels):
        inner = level[feature[level] >= 0]
        a = tree.left[inner]
        feature[inner[(feature[a] < 0) & (feature[a + 1] < 0) & (answer[a] == answer[a + 1])]] = -1
    kept, at = [levels[0]], levels[0]
    while len(inner := at[feature[at] >= 0]):
        at = np.stack([tree.left[inner], tree.left[inner] + 1], axis=1).reshape(-1).astype(np.int64)
        kept.append(at)
    order = np.concatenate(kept)
    place = np.zeros(len(feature), np.int32)
    place[order] = np.arange(len(order))
    return Tree(feature[order], tree.cut[order], place[tree.left[order]], tree.share[order])


def joined(top: Tree, below: dict[int, Tree]) -> Tree:
    """``top`` with some of its leaves replaced by trees."""
    columns, n = [[c.copy()] for c in top], len(top.feature)
    for node, tree in below.items():
        for column, c in zip(columns, tree):
            column[0][node] = c[0]
            column.append(c[1:])
        columns[2][0][node] += n - 1
        columns[2][-1] = columns[2][-1] + np.int32(n - 1)
        n += len(tree.feature) - 1
    return Tree(*[np.concatenate(c) for c in columns])


def _reached(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    flat, d = bins.reshape(-1), bins.shape[1]
    node, at = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(at := at[tree.feature[node[at]] >= 0]):
        here = node[at]
        node[at] = tree.left[here] + (flat[at * d + tree.feature[here]] > tree.cut[here])
    return node


def _sought(batches: Iterator[pa.RecordBatch], tops: Sequence[Tree], slots: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block and tree the drawn rows in nodes that have a slot: tree, slots, bins, labels, draws."""
    for batch in batches:
        for block in batch.to_pylist():
            ones = np.frombuffer(block["ones"], np.uint8)
            bins = np.frombuffer(block["bins"], np.uint8).reshape(len(ones), -1)
            drawn = np.frombuffer(block["drawn"], np.uint8).reshape(-1, len(ones))
            for t, slot in slots.items():
                r = np.flatnonzero(drawn[t])
                own = slot[_reached(tops[t], bins[r])]
                r, own = r[own >= 0], own[own >= 0]
                if len(r):
                    yield t, own, bins[r], ones[r], drawn[t][r]


def _slots(tops: Sequence[Tree], nodes: Sequence[tuple[int, int]]) -> dict[int, np.ndarray]:
    slots: dict[int, np.ndarray] = {}
    for i, (t, node) in enumerate(nodes):
        slots.setdefault(t, np.full(len(tops[t].feature), -1, np.int64))[node] = i
    return slots


def split_large(blocks: DataFrame, tops: Sequence[Tree], nodes: Sequence[tuple[int, int]], tried: np.ndarray, max_bins: int) -> dict[int, Any]:
    """The best split of each node, by its number in ``nodes``, from histograms of all tasks; -1 as a cut where none gains."""
    slots, width = _slots(tops, nodes), tried.shape[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(nodes), width, 2 * max_bins))
        for _, own, bins, ones, drawn in _sought(batches, tops, slots):
            low, high = own.min(), own.max() + 1
            key, weight, at = (2 * (own - low) + ones) * max_bins, drawn.astype(np.float64), np.arange(len(own))
            for j in range(width):
                found = np.bincount(key + bins[at, tried[own, j]], weight, 2 * (high - low) * max_bins)
                sums[low:high, j] += found.reshape(high - low, -1)
        seen = np.flatnonzero(sums.any(axis=(1, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array([sums[i].tobytes() for i in seen], pa.binary())], ["slot", "counts"])

    def choose(found: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(c.as_buffer(), np.float64) for c in found["counts"]).reshape(width, 2, max_bins)
        impurity, at = best_cuts(counts)
        j = int(impurity.argmin())
        left, every = counts[j, :, :at[j] + 1].sum(axis=1), counts[j].sum(axis=1)
        cut = int(at[j]) if gains(every[None], impurity[j:j + 1])[0] else -1
        slot = found["slot"][0].as_py()
        split = [slot, int(tried[slot, j]), cut, *left.tolist(), *(every - left).tolist()]
        return pa.table([pa.array([v], kind) for v, kind in zip(split, [pa.int64(), pa.int32(), pa.int32(), *[pa.float64()] * 4])], SPLITS.replace(",", "").split()[::2])

    counted = blocks.mapInArrow(count, "slot long, counts binary")
    return {r["slot"]: r for r in counted.groupBy("slot").applyInArrow(choose, SPLITS).collect()}


def grow_rest(blocks: DataFrame, tops: Sequence[Tree], nodes: Sequence[tuple[int, int]], depths: Sequence[int], max_bins: int, width: int, seed: int) -> dict[int, Tree]:
    """The subtree of each node, by its number in ``nodes``, grown where the node's drawn rows come together."""
    slots = _slots(tops, nodes)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own, bins, ones, drawn in _sought(batches, tops, slots):
            order = own.argsort(kind="stable")
            own, bins, ones, drawn = own[order], bins[order], ones[order], drawn[order]
            at = np.flatnonzero(np.diff(own, prepend=-1))
            ends = [*at[1:], len(own)]
            columns = [[c[a:z].tobytes() for a, z in zip(at, ends)] for c in (bins, ones, drawn)]
            yield pa.RecordBatch.from_arrays([pa.array(own[at], pa.int64()), *[pa.array(c, pa.binary()) for c in columns]], ["subtree", "bins", "ones", "drawn"])

    def finish(found: pa.Table) -> pa.Table:
        i = found["subtree"][0].as_py()
        bins, ones, drawn = (np.frombuffer(b"".join(found[c].to_pylist()), np.uint8) for c in ("bins", "ones", "drawn"))
        tree = pruned(grow(bins.reshape(len(ones), -1), ones, drawn, depths[i], max_bins, width, np.random.default_rng([seed, *nodes[i]])))
        parts = [pa.array([c.astype(kind).tobytes()], pa.binary()) for c, kind in zip(tree, KINDS)]
        return pa.table([pa.array([i], pa.int64()), *parts], ["subtree", *NODES])

    grown = blocks.mapInArrow(pieces, PIECES).groupBy("subtree").applyInArrow(finish, "subtree long, " + ", ".join(f"{c} binary" for c in NODES))
    return {r["subtree"]: Tree(*[np.frombuffer(r[c], kind) for c, kind in zip(NODES, KINDS)]) for r in grown.collect()}


def grow_forest(rows: DataFrame, trees: int, depth: int, max_bins: int, seed: int) -> GrownForestModel:
    """Fit to ``features`` (a vector) and ``label`` (0 or 1); both labels occur. ``rows`` is read twice."""
    spark, seed = rows.sparkSession, seed % 2**32
    rows = rows.select(F.col("label").cast("double").alias("label"), vector_to_array("features").alias("features"))
    limits, path = bin_limits(rows, max_bins), new_path(spark, "forest-blocks")
    dealt(rows, limits, trees, seed).write.parquet(path)
    try:
        grown = _grown(spark.read.schema(BLOCKS).parquet(path), trees, depth, max_bins, seed, len(limits))
    finally:
        remove(spark, path)
    return GrownForestModel([_scored_by(tree, limits) for tree in grown])


def _grown(blocks: DataFrame, trees: int, depth: int, max_bins: int, seed: int, features: int) -> list[Tree]:
    random, width = np.random.default_rng(seed), features if trees == 1 else math.ceil(math.sqrt(features))
    # Per tree its nodes so far as lists, in the order of Tree, and their depths.
    found = [([-1], [0], [0], [0.5], [0]) for _ in range(trees)]
    large, rest = [(t, 0) for t in range(trees)], []

    def tops() -> list[Tree]:
        return [Tree(*[np.array(c, kind) for c, kind in zip(f, KINDS)]) for f in found]

    while large:
        now, large = large[:NODES_PER_PASS], large[NODES_PER_PASS:]
        splits = split_large(blocks, tops(), now, tried_features(random, len(now), features, width), max_bins)
        for i, (t, node) in enumerate(now):
            feature, cut, left, share, depths = found[t]
            if i not in splits:  # A tree that drew no row.
                continue
            s = splits[i]
            share[node] = (s["l1"] + s["r1"]) / (s["l0"] + s["l1"] + s["r0"] + s["r1"])
            if s["cut"] < 0 or depths[node] == depth:
                continue
            feature[node], cut[node], left[node] = s["tried"], s["cut"], len(feature)
            for zeros, ones in ((s["l0"], s["l1"]), (s["r0"], s["r1"])):
                child = len(feature)
                for column, value in zip(found[t], (-1, 0, 0, ones / (zeros + ones), depths[node] + 1)):
                    column.append(value)
                if min(zeros, ones) > 0 and depths[child] < depth:
                    (large if zeros + ones > ROWS_PER_SUBTREE else rest).append((t, child))
    done = tops()
    below: list[dict[int, Tree]] = [{} for _ in done]
    if rest:
        left_over = [depth - found[t][4][node] for t, node in rest]
        for i, tree in grow_rest(blocks, done, rest, left_over, max_bins, width, seed).items():
            below[rest[i][0]][rest[i][1]] = tree
    return [pruned(joined(top, b)) for top, b in zip(done, below)]


Scored = tuple[np.ndarray, np.ndarray, np.ndarray]


def _scored_by(tree: Tree, limits: Sequence[np.ndarray]) -> Scored:
    """Feature, left child, and as a value the limit of an inner node or the share of a leaf."""
    value = tree.share.astype(np.float64)
    for f, own in enumerate(limits):
        here = tree.feature == f
        value[here] = own[tree.cut[here]]
    return tree.feature.astype(np.int16), tree.left.astype(np.int32), value


def positive_share(trees: Sequence[Scored], features: np.ndarray) -> np.ndarray:
    """Mean over the trees of the share of positive rows in the leaf that each row comes to."""
    flat, start, total = features.reshape(-1), np.arange(len(features)) * features.shape[1], np.zeros(len(features))
    for feature, left, value in trees:
        node, at = np.zeros(len(features), np.int64), np.arange(len(features))
        while len(at := at[feature[node[at]] >= 0]):
            here = node[at]
            node[at] = left[here] + (flat[start[at] + feature[here]] > value[here])
        total += value[node]
    return total / len(trees)


class GrownForestModel(Model, HasFeaturesCol, HasRawPredictionCol, HasProbabilityCol, HasPredictionCol, MLWritable, MLReadable):
    """A fitted forest of two classes as arrays, 14 bytes a node: they are sent to the workers once, not with every task."""

    def __init__(self, trees: Sequence[Scored] = ()):
        super().__init__()
        self.trees = list(trees)
        self._sent = None

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sent = self._sent = self._sent or dataset.sparkSession.sparkContext.broadcast(self.trees)

        @F.arrow_udf("double")
        def positive(features: pa.Array) -> pa.Array:
            if not len(features):
                return pa.array([], pa.float64())
            return pa.array(positive_share(sent.value, _matrix(features)))

        n, p = float(len(self.trees)), F.col("_positive")
        added = dataset.withColumn("_positive", positive(vector_to_array(self.getFeaturesCol())))
        return added.withColumns({
            self.getRawPredictionCol(): array_to_vector(F.array((1 - p) * n, p * n)),
            self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
            self.getPredictionCol(): (p > 0.5).cast("double"),
        }).drop("_positive")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: GrownForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = [(t, *[c.tobytes() for c in tree]) for t, tree in enumerate(self.model.trees)]
        self.sparkSession.createDataFrame(rows, "tree int, feature binary, left binary, value binary").write.parquet(f"{path}/data")


class _ForestReader(MLReader):
    def load(self, path: str) -> GrownForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path}/data").orderBy("tree").collect()
        kinds = (("feature", np.int16), ("left", np.int32), ("value", np.float64))
        model = GrownForestModel([tuple(np.frombuffer(r[c], kind) for c, kind in kinds) for r in rows])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
