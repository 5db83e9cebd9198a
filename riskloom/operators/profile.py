"""Reference profile of monitored features: missing ratio, moments and histogram."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.binning import (
    corrected_skewness,
    dense_counts,
    doane_bins,
    edges,
    equal_width_bin,
)
from riskloom.functions.features import present
from riskloom.schemas import MONITORED_FEATURES
from riskloom.session import at_rest


def long_values(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row and feature: ``feature``, ``value`` (null when missing)."""
    pairs = [F.struct(F.lit(f).alias("feature"), present(F.col(f)).alias("value")) for f in features]
    return df.select(*keep, F.inline(F.array(*pairs)))


def _summary(name: str) -> Column:
    x = present(F.col(name))
    return F.struct(
        F.lit(name).alias("feature"),
        F.count("*").alias("rows"),
        F.count(x).alias("n"),
        F.min(x).alias("lo"),
        F.max(x).alias("hi"),
        F.mean(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.skewness(x).alias("skew"),
    )


def summarise(df: DataFrame, features: Sequence[str] = tuple(MONITORED_FEATURES)) -> DataFrame:
    """One row per feature, all from one pass: counts, range, moments, number of bins.

    ``lo`` and ``hi`` are the histogram's range: data of a single value gets half a unit either side.
    """
    flat = F.col("lo") == F.col("hi")
    return (
        df.agg(F.array(*[_summary(f) for f in features]).alias("all"))
        .select(F.inline("all"))
        .withColumn("skew", corrected_skewness(F.col("n"), F.col("skew")))
        .select(
            "feature", "rows", "n",
            F.try_divide(F.col("rows") - F.col("n"), F.col("rows")).alias("missing_ratio"),
            "mean", "std", "skew",
            F.when(F.col("n") > 0, doane_bins(F.col("n"), F.coalesce("skew", F.lit(0.0)))).alias("num_bins"),
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )


def profile(df: DataFrame, features: Sequence[str] = tuple(MONITORED_FEATURES)) -> DataFrame:
    """The reference profile; a feature without any value has null histogram and moments.

    Two passes over the data: one for the summary, written once and used twice, one for the bins. Both
    broadcasts hold one row per feature in ``features``, however large the data.
    """
    summary = at_rest(summarise(df, features), "profile-summary")
    ranges = summary.where("n > 0").select("feature", "lo", "hi", "num_bins")
    counts = (
        long_values(df, features)
        .where("value IS NOT NULL")
        .join(F.broadcast(ranges), "feature")
        .groupBy("feature", equal_width_bin(F.col("value"), F.col("lo"), F.col("hi"), F.col("num_bins")).alias("bin"))
        .agg(F.count("*").alias("n"))
        .groupBy("feature")
        .agg(F.collect_list(F.struct("bin", "n")).alias("pairs"))
    )
    return summary.join(F.broadcast(counts), "feature", "left").select(
        "feature", "missing_ratio", "mean", "std",
        F.when(F.col("num_bins").isNotNull(), dense_counts(F.col("pairs"), F.col("num_bins"))).alias("hist"),
        F.when(F.col("num_bins").isNotNull(), edges(F.col("lo"), F.col("hi"), F.col("num_bins"))).alias("bin_edges"),
        "num_bins",
    )
