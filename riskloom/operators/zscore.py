"""Z-scores of income, over all rows and within each year, from a fitted state table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import broadcast_if_small

NOT_FITTED = "The z-score state holds no global and yearly statistics; fit it first."


def fit_state(df: DataFrame) -> DataFrame:
    """Mean and population deviation of income, globally and per year, in one aggregate.

    A deviation of zero (one row, or equal values) becomes 1.
    """
    spread = F.coalesce(F.col("std"), F.lit(0.0))
    return (
        df.rollup("year")
        .agg(
            F.mean("income").alias("mean"),
            F.stddev_pop("income").alias("std"),
            F.grouping_id().alias("level"),
        )
        .where("level = 1 OR year IS NOT NULL")
        .select(
            F.when(F.col("level") == 1, "global").otherwise("year").alias("scope"),
            F.col("year").cast("int").alias("year"),
            F.col("mean").cast("double").alias("mean"),
            F.when(spread == 0, 1.0).otherwise(spread).alias("std"),
        )
    )


def apply_state(df: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``income_z`` and ``income_z_by_year``; the latter is null for years never fitted.

    ``state`` should be at rest: it is looked at once for the global row and the number
    of years, and then joined, by broadcast where that number is small.
    """
    is_global = F.col("scope") == "global"
    known = state.agg(
        F.max(F.when(is_global, F.col("mean"))).alias("mean"),
        F.max(F.when(is_global, F.col("std"))).alias("std"),
        F.count_if(~is_global).alias("years"),
    ).first()
    if known["mean"] is None or known["years"] == 0:
        raise RuntimeError(NOT_FITTED)
    per_year = state.where(~is_global).select(
        F.col("year").alias("_year"), F.col("mean").alias("_mean"), F.col("std").alias("_std")
    )
    joined = df.join(broadcast_if_small(per_year, known["years"]), F.col("year") == F.col("_year"), "left")
    return joined.withColumns({
        "income_z": (F.col("income") - known["mean"]) / known["std"],
        "income_z_by_year": (F.col("income") - F.col("_mean")) / F.col("_std"),
    }).drop("_year", "_mean", "_std")
