"""Embedding whitening with Jacobi-Davidson eigenvectors of the covariance, which is never formed.

Every entry c becomes the whole number ``floor(SCALE * c)``; each distinct vector counts once. What the solver asks of the
data is the product of the covariance with a block of vectors, a Spark job over the distinct vectors that subtracts the
mean first: each task gives the sums of ``centred^T (centred W)`` of its rows, added up per dimension. All else has the
size of one vector times a block:

- Rayleigh-Ritz on the subspace found so far gives approximate pairs and their residuals.
- For the leading pairs, and some guards behind them, the projected correction equation
  ``(I - BB^T)(V - theta I)(I - BB^T) t = -r`` is solved by a few steps of MINRES, all pairs in one block of products a
  step; B holds the locked vectors and the Ritz vectors of the block. Orthonormalised, the corrections widen the subspace.
- Pairs are locked in falling order of their value when the residual is below ``TOLERANCE`` times the largest value, and
  the search goes on orthogonal to them. A subspace of ``6`` blocks is cut down to its best two.

Defined results: vectors that are null, empty or hold null, NaN or infinite entries are dropped, with their rows. Components without
variance (a value below 1e-12 of the trace: rank less than asked for, one distinct vector) have no rows. ``deviation`` is
exact, and null where it exceeds a long. Entries beyond a long after scaling take the nearest long. Null and repeated ids
are carried along; extra columns are ignored; vectors of different lengths are an error; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import vectors
from riskloom.llm.scratch import Scratch

SCALE = 256
COMPONENTS = 4
GUARDS = 4
INNER_STEPS = 6
INNER_GAIN = 0.03
TOLERANCE = 1e-13
NO_VARIANCE = 1e-12
CHUNK = 1 << 22


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, gain: float) -> np.ndarray:
    """Solve ``A x = right`` for symmetric operators, a column each, by at most ``steps`` Lanczos steps in lockstep."""
    x, w, w_before, v_before = (np.zeros_like(right) for _ in range(4))
    beta = np.linalg.norm(right, axis=0)
    start, rest = beta, beta.copy()
    v = right / np.where(beta > 0, beta, 1)
    beta = np.zeros_like(beta)
    c, s, c_before, s_before = (np.full(len(beta), z) for z in (1.0, 0.0, 1.0, 0.0))
    for _ in range(steps):
        y = product(v)
        alpha = (v * y).sum(axis=0)
        y = y - alpha * v - beta * v_before
        next_beta = np.linalg.norm(y, axis=0)
        # The new column of the tridiagonal matrix under the two rotations before, then its own rotation.
        first, second, third = s_before * beta, s * alpha + c_before * c * beta, c * alpha - c_before * s * beta
        length = np.hypot(third, next_beta)
        safe = np.where(length > 0, length, 1)
        c_before, s_before, c, s = c, s, np.where(length > 0, third / safe, 1), np.where(length > 0, next_beta / safe, 0)
        w, w_before = (v - first * w_before - second * w) / safe, w
        x = x + c * rest * w
        rest = -s * rest
        v, v_before, beta = y / np.where(next_beta > 0, next_beta, 1), v, next_beta
        if (np.abs(rest) <= gain * start).all():
            break
    return x


def against(block: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span the block outside the given orthonormal spaces, as far as it reaches outside."""
    for last in (False, True):
        block = block / np.maximum(np.linalg.norm(block, axis=0), np.finfo(float).tiny)
        for space in (*spaces, *spaces):
            block = block - space @ (space.T @ block)
        q, r = np.linalg.qr(block)
        block = q if last else q[:, np.abs(np.diag(r)) > 1e-8]
        if not block.shape[1]:
            break
    return block


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, guards: int = GUARDS, steps: int = INNER_STEPS,
    tolerance: float = TOLERANCE,
) -> tuple[np.ndarray, np.ndarray]:
    """The largest values and unit vectors of a symmetric operator without negative values, given by its products."""
    wanted = min(wanted, size)
    block = min(size, wanted + guards)
    space = against(np.random.default_rng(block).standard_normal((size, block)))
    image = product(space)
    values, locked, exhausted = [], np.zeros((size, 0)), False
    while True:
        inner = space.T @ image
        ritz, turn = np.linalg.eigh((inner + inner.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * ritz
        norms = np.linalg.norm(residual, axis=0)
        enough = tolerance * max(values[:1] or ritz[:1])
        done = 0
        # An exhausted subspace is all that is left of the space: its residuals are rounding.
        while done < len(ritz) and len(values) + done < wanted and (exhausted or norms[done] <= enough):
            done += 1
        values += ritz[:done].tolist()
        locked = np.hstack([locked, space[:, :done]])
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        space, image, ritz, residual = space[:, done:], image[:, done:], ritz[done:], residual[:, done:]
        ahead = min(wanted + guards - len(values), len(ritz))
        if space.shape[1] + ahead > 6 * block:
            space, image = space[:, : 2 * ahead], image[:, : 2 * ahead]
        basis = np.hstack([locked, space[:, :ahead]])

        def projected(z: np.ndarray) -> np.ndarray:
            return z - basis @ (basis.T @ z)

        def shifted(z: np.ndarray) -> np.ndarray:
            z = projected(z)
            return projected(product(z) - z * ritz[:ahead])

        if locked.shape[1] + space.shape[1] < size:
            correction = minres(shifted, -projected(residual[:, :ahead]), steps, INNER_GAIN)
            new = against(projected(correction), locked, space)
        else:
            new = np.zeros((size, 0))
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
        else:
            exhausted, image = True, product(space)


def totals(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of every dimension."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = vectors.matrix(batch["x"])
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])

    rows = fit.select("x").mapInArrow(step, "i bigint, n bigint, high bigint, low bigint").groupBy("i").agg(F.sum("n"), F.sum("high"), F.sum("low")).collect()
    sums = [0] * size
    for i, n, high, low in rows:
        sums[i] = (high << 32) + low
    return (rows[0][1] if rows else 0), sums


def summed(fit: DataFrame, mean: np.ndarray, height: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``part(centred rows)``, a matrix of ``height`` x ``width``."""
    names = [f"y{j}" for j in range(width)]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            x = vectors.matrix(batch["x"])
            rows = max(1, CHUNK // max(1, x.shape[1]))
            for lo in range(0, len(x), rows):
                total += part(x[lo : lo + rows] - mean)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height)), *(pa.array(total[:, j]) for j in range(width))], ["i", *names])

    schema = ", ".join(["i bigint", *(f"{c} double" for c in names)])
    rows = fit.select("x").mapInArrow(step, schema).groupBy("i").agg(*[F.sum(c) for c in names]).collect()
    out = np.zeros((height, width))
    for row in rows:
        out[row[0]] = row[1:]
    return out


def components(fit: DataFrame, size: int, n: int, sums: list[int], wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Values and unit vectors of the leading components that have variance, and the trace of the covariance."""
    mean = np.array([s / n for s in sums])
    trace = summed(fit, mean, 1, 1, lambda c: np.array([[np.einsum("ij,ij->", c, c)]]))[0, 0] / n

    def product(block: np.ndarray) -> np.ndarray:
        return summed(fit, mean, size, block.shape[1], lambda c: c.T @ (c @ block)) / n

    values, axes = leading_pairs(product, size, wanted)
    with_variance = values > NO_VARIANCE * trace
    return values[with_variance], axes[:, with_variance], trace


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """sum((n * x - S)^2) per row, exact; null beyond a long."""
    most = max([n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums))]) if x.size else 0
    if most * most * x.shape[1] < 1 << 62:
        apart = n * x - np.array(sums, np.int64)
        return pa.array((apart * apart).sum(axis=1))
    whole = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Id, component, n, deviation, whitened, explained and identity_error for every usable row and component."""
    spark, scratch = table.sparkSession, Scratch(table.sparkSession)
    kept = table.select(F.col(key).alias("id"), F.col(vector).alias("v")).where(vectors.usable("v"))
    rows = scratch.rest(kept.select("id", vectors.grid("v", scale).alias("x")), "vector-rows")
    fit = scratch.rest(rows.select("x").distinct(), "vector-fit")
    size = vectors.width(fit, "x")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    n, sums = totals(fit, size) if size else (0, [])
    values, axes, trace = components(fit, size, n, sums, wanted) if n else (np.zeros(0), np.zeros((0, 0)), 0.0)
    count = len(values)
    if not count:
        return spark.createDataFrame([], schema).withColumnRenamed("id", key)
    mean, scaled = np.array([s / n for s in sums]), axes / np.sqrt(values)
    spread = summed(fit, mean, count + 1, count, lambda c: np.vstack([(w := c @ scaled).T @ w, w.sum(axis=0)])) / n
    covariance = spread[:count] - np.outer(spread[count], spread[count])
    identity_error = float(np.abs(covariance - np.eye(count)).max())
    scratch.drop("vector-fit")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = vectors.matrix(batch["x"])
                each = pa.array(np.repeat(np.arange(len(x)), count))
                yield pa.RecordBatch.from_arrays([
                    batch["id"].take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), n)),
                    deviations(x, n, sums).take(each), pa.array(((x - mean) @ scaled).ravel()),
                    pa.array(np.tile(values / trace, len(x))), pa.array(np.full(len(each), identity_error)),
                ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(step, schema).withColumnRenamed("id", key)
