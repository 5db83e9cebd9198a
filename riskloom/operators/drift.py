"""Drift of live rows against a stored reference profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.binning import dense_counts, edge_bin, stability_index, total
from riskloom.operators.profile import long_values
from riskloom.schemas import MONITORED_FEATURES

# Bin codes for values that are in no bin.
MISSING, OUTSIDE = -1, -2


def named_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature name, so that each is reported even without data."""
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))


def bin_profile(profile: DataFrame, features: Sequence[str]) -> DataFrame:
    """The profile rows of the named features: at most one per name, so small enough to broadcast."""
    return profile.where(F.col("feature").isin(list(features))).dropDuplicates(["feature"])


def bin_live(live: DataFrame, profile: DataFrame, features: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """One row per live row and feature with its bin in the profile, for batch and stream alike."""
    have = [f for f in features if f in live.columns]
    binned = long_values(live, have, keep).join(
        F.broadcast(bin_profile(profile, have).select("feature", "bin_edges")), "feature"
    )
    place = F.coalesce(edge_bin(F.col("value"), F.col("bin_edges")), F.lit(OUTSIDE))
    return binned.withColumn("bin", F.when(F.col("value").isNull(), MISSING).otherwise(place)).drop("bin_edges")


def count_bins(binned: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Counts and moments per feature and bin. Partial sums leave each task before the shuffle."""
    return binned.groupBy(*by, "feature", "bin").agg(
        F.count("*").alias("n"), F.mean("value").alias("mean"), F.var_pop("value").alias("var")
    )


def _moments(parts: Column) -> tuple[Column, Column, Column]:
    """Count, mean and sample deviation merged from those of the bins."""
    filled = F.filter(parts, lambda p: p["bin"] != MISSING)
    n = F.aggregate(filled, F.lit(0).cast("long"), lambda acc, p: acc + p["n"])
    mean = F.try_divide(F.aggregate(filled, F.lit(0.0), lambda acc, p: acc + p["n"] * p["mean"]), n)
    squares = F.aggregate(
        filled, F.lit(0.0), lambda acc, p: acc + p["n"] * (p["var"] + (p["mean"] - mean) * (p["mean"] - mean))
    )
    return n, mean, F.when(n > 1, F.sqrt(squares / (n - 1)))


def score_bins(counts: DataFrame, profile: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Missing ratio, moments and stability index from bin counts.

    The arrays gathered here hold one entry per bin, a number that grows only with the
    logarithm of the profiled rows.
    """
    gathered = counts.groupBy(*by, "feature").agg(F.collect_list(F.struct("bin", "n", "mean", "var")).alias("parts"))
    known = bin_profile(profile, features).select("feature", "hist", "num_bins")
    parts = F.col("parts")
    n, mean, std = _moments(parts)
    missing = F.aggregate(
        F.filter(parts, lambda p: p["bin"] == MISSING), F.lit(0).cast("long"), lambda acc, p: acc + p["n"]
    )
    inside = F.transform(
        F.filter(parts, lambda p: p["bin"] >= 0), lambda p: F.struct(p["bin"].alias("bin"), p["n"].alias("n"))
    )
    measured = (
        gathered.join(F.broadcast(known), "feature")
        .select(
            *by, "feature", "hist",
            n.alias("live_values"), (n + missing).alias("live_rows"),
            mean.alias("mean"), std.alias("std"),
            F.when(F.col("hist").isNotNull(), dense_counts(inside, F.col("num_bins"))).alias("live_hist"),
        )
        .withColumn("reason", _reason())
    )
    psi = F.when(F.col("reason").isNull(), stability_index(F.col("hist"), F.col("live_hist")))
    return measured.select(
        *by, "feature",
        F.try_divide(F.col("live_rows") - F.col("live_values"), F.col("live_rows")).alias("missing_ratio"),
        "mean", "std", psi.alias("psi"), "reason",
    )


def _reason() -> Column:
    """Why no stability index can be given, or null when it can."""
    return (
        F.when(F.col("hist").isNull(), "no_reference_values")
        .when(F.col("live_values") == 0, "no_live_values")
        .when(total(F.col("live_hist")) == 0, "no_live_values_in_bins")
    )


def drift(profile: DataFrame, live: DataFrame, features: Sequence[str] = tuple(MONITORED_FEATURES)) -> DataFrame:
    """One row per monitored feature, in one pass over the live rows."""
    scored = score_bins(count_bins(bin_live(live, profile, features)), profile, features)
    return (
        named_features(live, features)
        .join(F.broadcast(scored), "feature", "left")
        .withColumn(
            "reason",
            F.when(F.col("missing_ratio").isNull(), F.coalesce("reason", F.lit("unknown_feature"))).otherwise(F.col("reason")),
        )
    )
