"""From raw rows to a balanced two-class table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.sampling import take_first
from riskloom.schemas import CLEAN_LABEL, NUMERIC_COLUMNS, SEED, TARGET

# Columns that tell raw rows apart. Sampling stays exact where they do not.
ROW_KEY = ["address", "year", "day"]


def is_positive() -> Column:
    """1 for any label but the clean one, 0 for that one, null without a label."""
    return (F.col("label") != CLEAN_LABEL).cast("int")


def fill_numeric(df: DataFrame) -> DataFrame:
    """Null and NaN become 0 in the numeric raw columns."""
    return df.fillna({c: 0.0 for c in NUMERIC_COLUMNS if c in df.columns})


def drop_identifier(df: DataFrame) -> DataFrame:
    return df.drop("address")


def clean(df: DataFrame) -> DataFrame:
    return drop_identifier(fill_numeric(df))


def class_counts(df: DataFrame) -> DataFrame:
    """Rows per class in one aggregate; unlabelled rows are the null class."""
    return df.groupBy(is_positive().alias(TARGET)).agg(F.count("*").alias("n"))


def binarise(df: DataFrame) -> DataFrame:
    """Replace the label by the 0/1 target; rows without a label belong to neither class."""
    return df.where(F.col("label").isNotNull()).withColumn(TARGET, is_positive()).drop("label")


def balancing_quota(sizes: dict[int, int]) -> dict[int, int]:
    """How many clean rows to keep so that both classes are equally large."""
    clean_rows, positives = sizes.get(0, 0), sizes.get(1, 0)
    if clean_rows == 0:
        raise ValueError(f"There are no rows labelled '{CLEAN_LABEL}' to sample from.")
    if positives > clean_rows:
        raise ValueError(f"Cannot balance {positives} positive rows with only {clean_rows} clean ones.")
    return {0: positives}


def balance(df: DataFrame, key: Sequence[str] = ROW_KEY, seed: int = SEED) -> DataFrame:
    """All positive rows and exactly as many clean ones, chosen by row hash."""
    return take_first(df, TARGET, balancing_quota, key, seed)


def preprocess(raw: DataFrame, key: Sequence[str] = ROW_KEY, seed: int = SEED) -> DataFrame:
    """Fill, binarise, balance and drop the identifier."""
    return drop_identifier(balance(binarise(fill_numeric(raw)), key, seed))
