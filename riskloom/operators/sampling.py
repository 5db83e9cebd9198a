"""Exact, reproducible sampling without a global sort.

Rows are ordered by a hash of their key. The hash spreads them evenly over short hex
prefixes ("buckets"), so a count per bucket finds the one bucket a given rank falls
in, and only that bucket is looked at more closely. What comes out is a hash value to
compare with, so the sample itself is a plain filter: no row is shuffled.

Copies of a row share one hash. They are counted, never sorted, so a group of copies
may be of any size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.hashing import below, order_hash, uniform
from riskloom.session import at_rest
from riskloom.schemas import LIVE_DRAWS, LIVE_MISSING_RATE, NUM_FOLDS, SEED, TARGET, TEST_FRACTION

# Hex digits by which buckets are told apart: 4096 of them where ranks are looked for, in
# buckets within buckets while they hold many rows, and 65,536 where single rows are drawn.
DIGITS, DRAW_DIGITS, ALL_DIGITS = 3, 4, 32
# Strata are counted on the driver; more of them than this are refused.
MAX_STRATA = 1000
# A bucket with at most this many rows is ordered by full hash in one task.
ROWS_PER_TASK = 1_000_000
# Copies written out by one task when a group of equal rows has to be divided.
COPIES_PER_TASK = 1_000_000

Cuts = dict[Any, list[int]]


@dataclass(frozen=True)
class Spot:
    """Where rank ``rank`` of a stratum lies: ``n`` rows have hashes beginning with ``prefix``, ``before`` come earlier."""

    stratum: Any
    rank: int
    prefix: str
    before: int
    n: int

    @property
    def splits_copies(self) -> bool:
        return self.rank < self.before + self.n


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _running(df: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """Adds ``before``: the sum of ``n`` over earlier rows."""
    window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))


def assign_segments(
    df: DataFrame,
    strata: str,
    cuts: Callable[[dict[Any, int]], Cuts],
    key: Sequence[str],
    seed: int = SEED,
    into: str = "segment",
) -> DataFrame:
    """Number the rows of each stratum by hash rank: 0 up to the first cut, 1 up to the second...

    ``cuts`` gets the row count of every stratum and returns ascending ranks for each.
    Strata are the few classes of a label, ``MAX_STRATA`` at most; rows without one are left out. The input is
    read once more per level of buckets (two for up to four billion rows a stratum, and
    one for each further 4096-fold) and once for the result, so it should be a table at rest.
    """
    rows = df.where(F.col(strata).isNotNull())
    hashed = rows.select(F.col(strata).alias("_stratum"), order_hash(key, seed).alias("_hash"))
    counts = _count_prefixes(hashed, DIGITS).persist()
    try:
        sizes = {r["_stratum"]: r["n"] for r in counts.groupBy("_stratum").agg(F.sum("n").alias("n")).limit(MAX_STRATA + 1).collect()}
        if len(sizes) > MAX_STRATA:
            raise ValueError(f"Column '{strata}' has more than {MAX_STRATA} values; strata are the few classes of a label.")
        wanted = cuts(sizes)
        whole = [
            Spot(s, c, "", 0, sizes[s]) for s, ranks in wanted.items() for c in ranks if 0 < c < sizes.get(s, 0)
        ]
        spots = _narrow(counts, whole)
    finally:
        counts.unpersist()
    # After three levels only copies, which are summed up anyway, can still fill a bucket.
    while any(s.n > ROWS_PER_TASK for s in spots) and len(spots[0].prefix) < 3 * DIGITS:
        spots = _narrow(_count_prefixes(_within(hashed, spots), len(spots[0].prefix) + DIGITS), spots)
    if spots:
        spots = _narrow(_count_prefixes(_within(hashed, spots), ALL_DIGITS), spots)

    hash_value = order_hash(key, seed)
    steps = [F.when((F.col(strata) == t.stratum) & (hash_value > t.prefix), 1).otherwise(0) for t in spots]
    # A cut at 0 puts every row of the stratum past it; one at the full size none.
    steps += [
        F.when(F.col(strata) == s, 1).otherwise(0) for s, ranks in wanted.items() for c in ranks if c <= 0
    ]
    numbered = rows.withColumn(into, reduce(lambda a, b: a + b, steps, F.lit(0)))
    divided = sorted({(t.stratum, t.prefix) for t in spots if t.splits_copies})
    if not divided:
        return numbered
    shared = _any([(F.col(strata) == s) & (hash_value == h) for s, h in divided])
    parts = [numbered.where(~shared)]
    for s, h in divided:
        tied = rows.where((F.col(strata) == s) & (hash_value == h))
        here = [t for t in spots if (t.stratum, t.prefix) == (s, h) and t.splits_copies]
        first = sum(1 for c in wanted[s] if c <= here[0].before)
        ranks = [t.rank - t.before for t in here]
        if set(key) >= set(df.columns):
            part = _divide_copies(tied, ranks, into)
        else:
            # Rows alike in the key but perhaps not elsewhere: order them by the whole row.
            part = assign_segments(tied, strata, lambda _, s=s, ranks=ranks: {s: ranks}, df.columns, seed, into)
        parts.append(part.withColumn(into, F.col(into) + first))
    return reduce(DataFrame.unionByName, parts)


def _count_prefixes(hashed: DataFrame, digits: int) -> DataFrame:
    """Rows per stratum and hash prefix. Copies of a row are summed up before the shuffle."""
    return hashed.groupBy("_stratum", F.substring("_hash", 1, digits).alias("_prefix")).agg(F.count("*").alias("n"))


def _within(hashed: DataFrame, spots: Sequence[Spot]) -> DataFrame:
    places = {(s.stratum, s.prefix) for s in spots}
    return hashed.where(_any([(F.col("_stratum") == s) & F.col("_hash").startswith(p) for s, p in sorted(places)]))


def _narrow(counts: DataFrame, spots: Sequence[Spot]) -> list[Spot]:
    """Find each spot's rank among the longer prefixes counted inside it; one row per spot comes back."""
    if not spots:
        return []
    length = len(spots[0].prefix)
    begun = reduce(
        lambda rest, s: F.when(
            (F.col("_stratum") == s.stratum) & F.col("_prefix").startswith(s.prefix), s.before
        ).otherwise(rest),
        spots,
        F.lit(None).cast("long"),
    )
    running = _running(
        counts.withColumn("_outer", F.substring("_prefix", 1, length)), ["_stratum", "_outer"], "_prefix"
    ).withColumn("before", F.col("before") + begun)

    def holds(s: Spot) -> Column:
        return (F.col("_stratum") == s.stratum) & (F.col("before") < s.rank) & (F.col("before") + F.col("n") >= s.rank)

    found = running.where(_any([holds(s) for s in spots])).collect()
    return [
        Spot(s.stratum, s.rank, r["_prefix"], r["before"], r["n"])
        for s in spots
        for r in found
        if r["_stratum"] == s.stratum and r["before"] < s.rank <= r["before"] + r["n"]
    ]


def _divide_copies(tied: DataFrame, ranks: Sequence[int], into: str) -> DataFrame:
    """Share out equal rows over segments: count them, then write the counts out again."""
    columns = tied.columns
    earlier = Window.orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    # One row per distinct content, and all of them share one hash: in practice a single row.
    counted = tied.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    )

    def up_to(rank: int | None) -> Column:
        if rank is None:
            return F.col("_n")
        return F.least(F.greatest(F.lit(rank) - F.col("_before"), F.lit(0)), F.col("_n"))

    ends = [0, *ranks, None]
    shares = F.array(*[
        F.struct(F.lit(i).alias("segment"), (up_to(ends[i + 1]) - up_to(ends[i])).alias("n"))
        for i in range(len(ranks) + 1)
    ])
    per_task = F.lit(COPIES_PER_TASK)
    blocks = (
        counted.select(*columns, F.inline(shares).alias(into, "_share"))
        .where("_share > 0")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_share") - 1) / per_task))))
        .repartition(into, "_block")
    )
    size = F.least(per_task, F.col("_share") - F.col("_block") * per_task)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(*columns, into)


def take_first(
    df: DataFrame, strata: str, quota: Callable[[dict[Any, int]], dict[Any, int]],
    key: Sequence[str], seed: int = SEED,
) -> DataFrame:
    """The first ``quota`` rows of each stratum in hash order; strata without a quota stay whole."""
    segmented = assign_segments(df, strata, lambda n: {s: [q] for s, q in quota(n).items()}, key, seed, "_segment")
    return segmented.where("_segment = 0").drop("_segment")


def train_sizes(sizes: dict[Any, int], test_fraction: float) -> dict[Any, int]:
    """Training rows per class: the exact total, shared out by largest remainder."""
    rows = sum(sizes.values())
    train = rows - math.ceil(rows * test_fraction)
    shares = {s: divmod(train * n, rows) for s, n in sizes.items()}
    left = train - sum(whole for whole, _ in shares.values())
    extra = sorted(shares, key=lambda s: (-shares[s][1], s))[:left]
    return {s: whole + (s in extra) for s, (whole, _) in shares.items()}


def stratified_split(
    df: DataFrame, key: Sequence[str], strata: str = TARGET,
    test_fraction: float = TEST_FRACTION, seed: int = SEED,
) -> DataFrame:
    """Adds ``split``: 'test' or 'train', with the same class mix in both."""
    if strata not in df.columns:
        raise ValueError(f"Column '{strata}' is needed to split the rows.")

    def cuts(sizes: dict[Any, int]) -> Cuts:
        train = train_sizes(sizes, test_fraction)
        return {s: [n - train[s]] for s, n in sizes.items()}

    marked = assign_segments(df, strata, cuts, key, seed, "_segment")
    return marked.withColumn("split", F.when(F.col("_segment") == 0, "test").otherwise("train")).drop("_segment")


def assign_folds(
    df: DataFrame, key: Sequence[str], strata: str = TARGET, folds: int = NUM_FOLDS, seed: int = SEED,
) -> DataFrame:
    """Adds ``fold`` 0..folds-1; fold sizes differ by at most one row per class."""

    def cuts(sizes: dict[Any, int]) -> Cuts:
        return {
            s: [i * (n // folds) + min(i, n % folds) for i in range(1, folds)] for s, n in sizes.items()
        }

    return assign_segments(df, strata, cuts, key, seed, "fold")


def bootstrap(df: DataFrame, key: Sequence[str], draws: int = LIVE_DRAWS, seed: int = SEED) -> DataFrame:
    """``draws`` rows drawn with replacement, with ``draw`` as their number.

    Draw ``i`` takes the row of hash rank ``hash(i) mod N``. Buckets without a draw are
    filtered out before anything is shuffled. Draws meet rows inside cells of equal
    rank span, where the row last begun at or before the drawn rank is the one drawn.
    """
    spark = df.sparkSession
    bucket = F.substring(order_hash(key, seed), 1, DRAW_DIGITS)
    hist = at_rest(df.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("n")), "buckets")
    rows = hist.agg(F.sum("n")).first()[0]
    if not rows:
        raise ValueError("There are no rows to draw from.")
    span = max(1, rows // 16**DRAW_DIGITS)
    offsets = _running(hist, [], "_bucket")

    drawn = spark.range(draws).select(
        F.col("id").alias("draw"),
        below([F.lit("draw"), F.col("id")], seed, F.lit(rows)).alias("_rank"),
    ).withColumn("_cell", F.floor(F.col("_rank") / span))

    def cells(first: Column, n: Column) -> Column:
        return F.sequence(F.floor(first / span), F.floor((first + n - 1) / span))

    # At most two rows for each of the 16**DRAW_DIGITS buckets, and one draw is enough to keep a bucket.
    spots = offsets.withColumn("_cell", F.explode(cells(F.col("before"), F.col("n"))))
    hit = (
        drawn.join(F.broadcast(spots), "_cell")
        .where((F.col("_rank") >= F.col("before")) & (F.col("_rank") < F.col("before") + F.col("n")))
        .select("_bucket", F.col("before").alias("_base"))
        .distinct()
    )
    hit_rows = (
        df.withColumn("_bucket", bucket)
        .join(F.broadcast(hit), "_bucket")
        .groupBy("_bucket", "_base", order_hash(key, seed).alias("_hash"), F.struct(*df.columns).alias("_row"))
        .agg(F.count("*").alias("n"))
    )
    order = Window.partitionBy("_bucket").orderBy("_hash", "_row")
    begun = hit_rows.withColumn(
        "_rank",
        F.col("_base") + F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    marks = begun.select(
        F.explode(cells(F.col("_rank"), F.col("n"))).alias("_cell"), "_rank", F.lit(None).cast("long").alias("draw"), "_row"
    )
    wanted = drawn.select("_cell", "_rank", "draw", F.lit(None).cast(marks.schema["_row"].dataType).alias("_row"))
    by_rank = Window.partitionBy("_cell").orderBy("_rank", F.col("draw").asc_nulls_first())
    met = marks.unionByName(wanted).withColumn(
        "_row", F.last("_row", ignorenulls=True).over(by_rank.rowsBetween(Window.unboundedPreceding, 0))
    )
    return met.where(F.col("draw").isNotNull()).select("draw", "_row.*")


def inject_missing(
    df: DataFrame, features: Sequence[str], key: Sequence[str],
    rate: float = LIVE_MISSING_RATE, seed: int = SEED,
) -> DataFrame:
    """Set each feature to null with probability ``rate``, decided by a hash of row key and feature."""
    return df.withColumns({
        f: F.when(uniform([*key, F.lit(f)], seed) >= rate, F.col(f)) for f in features
    })
