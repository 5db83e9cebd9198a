"""Mix sources to target weights by weighted fair queueing.

Each source is a flow whose documents wait in a hashed order, up to ``EPOCHS`` rounds of it. A copy of a document has
the virtual finish time (words of its source up to and with it) / (target of the source); the mix takes copies
in order of finish time until the next would pass the total budget. Running sums are taken per (source, hash
prefix) and per range of finish times, on top of the sums of the ranges before, so no source and no range of time
is ordered in one task whole.

Defined results: a null text has size 0; a null source is a source of its own, the last; documents of size 0 and
sources without words take 0; repeated rows are documents of their own; an empty table gives an empty result. Extra
columns are ignored. Ties in finish time are taken or left together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import at_rest

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
TIME_BINS = 4096
SOLID = "[^ \\t-\\r]+"


def sizes(docs: DataFrame) -> DataFrame:
    """Size in words and place in the shuffled order; no text is carried on."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(SOLID)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target: shares by weight, filled up to ``epochs`` times the size of a source.

    Sources in order of the level at which they are full: one is full if the level that the ones before leave
    reaches its own. The windows run over one row per source.
    """
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = numbered.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("full", F.lit(float(epochs)) * F.col("source_size") / F.col("weight"))
    order, whole = Window.orderBy("full", "rank"), Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    left = share * F.sum("source_size").over(whole) - float(epochs) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), none)
    levels = weighed.withColumn("level", left / open_weight)
    levels = levels.withColumn("is_full", F.col("level") >= F.col("full"))
    final = F.min(F.when(~F.col("is_full"), F.struct("full", "rank", "level"))).over(whole)["level"]
    target = F.when(F.col("is_full"), float(epochs) * F.col("source_size")).otherwise(F.col("weight") * final)
    return levels.select("source", "source_size", target.alias("target"))


def finish(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Adds source_size, target and ``upto``, the words of the source up to and with each document."""
    goals = goals.withColumnRenamed("source", "goal_source")
    found = rows.join(F.broadcast(goals) if goals.count() <= 200_000 else goals, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    found = found.withColumn("bin", F.substring("place", 1, 3))
    sums = found.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("s"), F.col("bin").alias("b"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bin").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return found.withColumn("within", F.sum("size").over(inside)).join(
        offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))
    ).withColumn("upto", F.col("offset") + F.col("within")).drop("s", "b", "bin", "offset", "within", "place")


def finish_time(epoch: int) -> Column:
    return (F.lit(epoch) * F.col("source_size") + F.col("upto")) / F.col("target")


def cut_time(rows: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> float:
    """The latest finish time up to which all copies together stay within the budget."""
    waiting = rows.where("size > 0 AND target > 0")
    total = waiting.agg(F.sum("size")).first()[0]
    if not total:
        return 0.0
    times = F.explode(F.array(*[finish_time(e) for e in range(epochs)])).alias("t")
    copies = waiting.select("size", times).withColumn("bin", F.least(F.floor(F.col("t") * TIME_BINS), F.lit(4 * TIME_BINS)))
    spent, low = 0, None
    for row in copies.groupBy("bin").agg(F.sum("size").alias("words")).orderBy("bin").collect():
        if spent + row["words"] > share * total:
            low = row["bin"]
            break
        spent += row["words"]
    if low is None:
        return float("inf")
    steps = copies.where(F.col("bin") == low).groupBy("t").agg(F.sum("size").alias("words"))
    running = steps.withColumn("sum", F.sum("words").over(Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)))
    best = running.where(F.col("sum") + spent <= share * total).agg(F.max("t")).first()[0]
    if best is None:
        best = copies.where(F.col("bin") < low).agg(F.max("t")).first()[0]
    return 0.0 if best is None else best


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) for every document."""
    rows = at_rest(sizes(docs), "sizes")
    queued = at_rest(finish(rows, at_rest(targets(rows, weights, share, epochs), "targets")), "queued")
    cut = cut_time(queued, share, epochs)
    rounds = sum((F.when(finish_time(e) <= F.lit(cut), 1).otherwise(0) for e in range(epochs)), F.lit(0))
    taken = F.when(F.col("target") > 0, F.col("size") * rounds).otherwise(0)
    return queued.select("doc_id", "size", "source_size", "target", taken.cast("bigint").alias("taken"))
