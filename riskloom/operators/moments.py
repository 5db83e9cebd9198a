"""Statistics that loads can be added to: training need not read again what it has read.

A load is reduced to one row per (year, column): rows, values, mean, the second and third sums of powers around that mean,
least and largest value. Rows of any number of loads add up to the row of their union: with ``d`` the distance of a part's mean
from the common one, the sums become ``m2 + n d^2`` and ``m3 + 3 d m2 + n d^3``. Unlike plain sums of powers these do not
cancel out, so the result agrees with one pass over everything to rounding. The z-score state and the profile's
summary are both read from them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.binning import corrected_skewness, doane_bins
from riskloom.functions.features import present
from riskloom.schemas import MONITORED_FEATURES

PARTS = ["rows", "n", "mean", "m2", "m3", "lo", "hi"]


def _moments(name: str) -> Column:
    x = present(F.col(name).cast("double"))
    n = F.count(x)
    m2 = F.coalesce(F.var_pop(x), F.lit(0.0)) * n
    skew = F.coalesce(F.nanvl(F.skewness(x), F.lit(0.0)), F.lit(0.0))
    m3 = skew * F.when(n > 0, F.pow(m2 / n, F.lit(1.5))).otherwise(0.0) * n
    columns = (F.count("*"), n, F.mean(x), m2, m3, F.min(x), F.max(x))
    return F.struct(F.lit(name).alias("feature"), *[c.alias(p) for c, p in zip(columns, PARTS)])


def load_moments(df: DataFrame, features: Sequence[str] = tuple(MONITORED_FEATURES), by: Sequence[str] = ("year",)) -> DataFrame:
    """One row per group and feature of a load, from one aggregate. Nulls and NaN are rows without a value."""
    return df.groupBy(*by).agg(F.array(*[_moments(f) for f in features]).alias("all")).select(*by, F.inline("all"))


def merge(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The moments of the union of all rows that the parts of a group stand for; one part per load and finer group."""
    filled = F.filter("parts", lambda p: p["n"] > 0)

    def added(term) -> Column:
        return F.aggregate(filled, F.lit(0.0), lambda acc, p: acc + term(p, p["mean"] - F.col("mean")))

    gathered = parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("rows", "n")], F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.collect_list(F.struct("n", "mean", "m2", "m3")).alias("parts"),
    )
    total = F.aggregate(filled, F.lit(0.0), lambda acc, p: acc + p["n"] * p["mean"])
    centred = gathered.withColumn("mean", F.try_divide(total, F.col("n")))
    return centred.withColumns({
        "m2": added(lambda p, d: p["m2"] + p["n"] * d * d),
        "m3": added(lambda p, d: p["m3"] + 3 * d * p["m2"] + p["n"] * d * d * d),
    }).select(*by, *PARTS)


def zscore_state(parts: DataFrame, feature: str = "income") -> DataFrame:
    """The fitted z-score state: one global row, and one per year. A deviation of zero becomes 1."""
    of_feature = parts.where(F.col("feature") == feature)
    years = merge(of_feature, ["year"]).where("year IS NOT NULL").select(F.lit("year").alias("scope"), F.col("year").cast("int").alias("year"), *PARTS)
    whole = merge(of_feature, ["feature"]).select(F.lit("global").alias("scope"), F.lit(None).cast("int").alias("year"), *PARTS)
    spread = F.coalesce(F.sqrt(F.try_divide("m2", "n")), F.lit(0.0))
    return whole.unionByName(years).select("scope", "year", "mean", F.when(spread == 0, 1.0).otherwise(spread).alias("std"))


def profile_summary(parts: DataFrame) -> DataFrame:
    """One row per feature as the profile's summary has it: counts, range, moments, number of bins."""
    merged = merge(parts, ["feature"])
    n, flat = F.col("n"), F.col("lo") == F.col("hi")
    skew = F.when(n > 0, F.coalesce(F.try_divide(F.col("m3") / n, F.pow(F.col("m2") / n, F.lit(1.5))), F.lit(0.0)))
    return merged.withColumn("skew", corrected_skewness(n, skew)).select(
        "feature", "rows", "n",
        F.try_divide(F.col("rows") - n, F.col("rows")).alias("missing_ratio"),
        "mean", F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"), "skew",
        F.when(n > 0, doane_bins(n, F.coalesce("skew", F.lit(0.0)))).alias("num_bins"),
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
