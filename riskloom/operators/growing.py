"""Splits that stay as they are when rows arrive.

Ranks of a hash move with every new row, so a split made anew sends rows from test to train between two trainings.
Here each load is dealt once. What is kept of it is a small table: per load, class and segment the hash up to which the
load's rows belong to it, and how many they are. A row's segment follows from its load and its hash alone, whatever
loads come later. New rows are dealt by hash too, and the cut of a new load is put where the sizes over all loads come out
right, so against the cut before only rows at the margin go elsewhere, and only new ones.

Sizes over all loads are those of a split made anew as long as new rows can make up for it, and off by less than the copies
of one row at each cut (copies share a hash and stay together).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.hashing import order_hash
from riskloom.operators.sampling import assign_segments, train_sizes
from riskloom.schemas import NUM_FOLDS, SEED, TARGET, TEST_FRACTION
from riskloom.session import at_rest

CUTS = "load long, class string, segment int, upto string, rows long"


def schema() -> T.StructType:
    return T.StructType.fromDDL(CUTS)


#: Beyond every hash: the last segment of a class has no end.
LAST = "g"

Sizes = dict[Any, int]


def split_targets(test_fraction: float = TEST_FRACTION) -> Callable[[Sizes], dict[Any, list[int]]]:
    """Test rows (segment 0) and training rows (segment 1) of each class."""

    def targets(sizes: Sizes) -> dict[Any, list[int]]:
        train = train_sizes(sizes, test_fraction)
        return {s: [n - train[s], train[s]] for s, n in sizes.items()}

    return targets


def fold_targets(folds: int = NUM_FOLDS) -> Callable[[Sizes], dict[Any, list[int]]]:
    def targets(sizes: Sizes) -> dict[Any, list[int]]:
        return {s: [n // folds + (i < n % folds) for i in range(folds)] for s, n in sizes.items()}

    return targets


def shares(new: int, wanted: list[int], have: list[int]) -> list[int]:
    """How many of ``new`` rows each segment gets, so that all come as near to ``wanted`` as can be."""
    short = [max(0, w - h) for w, h in zip(wanted, have)]
    out = []
    for i, s in enumerate(short):
        left, ahead = new - sum(out), sum(short[i:])
        out.append(left if i == len(short) - 1 else min(left, s if ahead <= left else -(-left * s // ahead) if ahead else 0))
    return out


def deal_load(
    rows: DataFrame, load: int, dealt: DataFrame, key: Sequence[str], targets: Callable[[Sizes], dict[Any, list[int]]],
    strata: str = TARGET, seed: int = SEED,
) -> DataFrame:
    """The cuts of a new load, to be appended to those ``dealt`` before (an empty table for the first one).

    ``rows`` holds the load's rows only. The table has one row per load, class and segment; classes are few.
    """
    held: dict[str, dict[int, int]] = {}
    for r in dealt.groupBy("class", "segment").agg(F.sum("rows").alias("rows")).collect():
        held.setdefault(r["class"], {})[r["segment"]] = r["rows"]
    given: dict[Any, list[int]] = {}

    def cuts(sizes: Sizes) -> dict[Any, list[int]]:
        before = {s: sum(held.get(str(s), {}).values()) for s in sizes}
        wanted = targets({s: n + before[s] for s, n in sizes.items()})
        for s, n in sizes.items():
            given[s] = shares(n, wanted[s], [held.get(str(s), {}).get(i, 0) for i in range(len(wanted[s]))])
        return {s: [sum(parts[: i + 1]) for i in range(len(parts) - 1)] for s, parts in given.items()}

    ranked = assign_segments(rows, strata, cuts, key, seed, "_segment")
    ends = ranked.groupBy(F.col(strata).alias("_class"), "_segment").agg(F.max(order_hash(key, seed)).alias("end")).collect()
    by_class: dict[Any, list[str]] = {}
    for s, parts in given.items():
        found = {r["_segment"]: r["end"] for r in ends if r["_class"] == s}
        reached, upto = "", []
        for i in range(len(parts)):
            reached = LAST if i == len(parts) - 1 else max(reached, found.get(i, reached))
            upto.append(reached)
        by_class[s] = upto
    table = [(load, str(s), i, u, 0) for s, uptos in by_class.items() for i, u in enumerate(uptos)]
    made = rows.sparkSession.createDataFrame(table, CUTS)
    marked = apply_cuts(rows.withColumn("_load", F.lit(load).cast("long")), made, key, "_load", "_segment", strata, seed)
    counted = marked.groupBy(F.col(strata).cast("string").alias("class"), F.col("_segment").alias("segment")).agg(F.count("*").alias("_rows"))
    full = made.drop("rows").join(F.broadcast(counted), ["class", "segment"], "left")
    return at_rest(full.select("load", "class", "segment", "upto", F.coalesce("_rows", F.lit(0).cast("long")).alias("rows")), "cuts")


def apply_cuts(
    df: DataFrame, cuts: DataFrame, key: Sequence[str], load: str = "load", into: str = "segment", strata: str = TARGET, seed: int = SEED,
) -> DataFrame:
    """The rows of all loads with their segment; rows of no class, or of a load not dealt, are left out.

    The cuts of a load fit one row: the join is by load and class, with a handful of hashes each.
    """
    folded = cuts.groupBy(F.col("load").alias("_of_load"), F.col("class").alias("_of_class")).agg(
        F.array_sort(F.collect_list(F.struct("segment", "upto"))).alias("_cuts"))
    hash_value = order_hash(key, seed)
    within = F.filter("_cuts", lambda c: c["upto"] >= hash_value)
    joined = df.join(F.broadcast(folded), (F.col(load) == F.col("_of_load")) & (F.col(strata).cast("string") == F.col("_of_class")))
    return joined.withColumn(into, F.get(within, F.lit(0))["segment"]).drop("_of_load", "_of_class", "_cuts")


def named_split(segment: Column) -> Column:
    return F.when(segment == 0, "test").otherwise("train")
