"""Stateless features and the column contract of the model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.features import calendar_columns, nonnegative, ratio_columns
from riskloom.schemas import EPOCH_YEAR, FEATURE_COLUMNS, LOGGED_COLUMNS, TARGET, UNMODELLED_COLUMNS


def add_logs(df: DataFrame, columns: Sequence[str] = tuple(LOGGED_COLUMNS)) -> DataFrame:
    """Clamp the columns at zero in place and add their ``log1p``."""
    clamped = df.withColumns({c: nonnegative(c) for c in columns})
    return clamped.withColumns({f"log_{c}": F.log1p(c) for c in columns})


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(ratio_columns())


def add_calendar(df: DataFrame) -> DataFrame:
    """Day count and yearly cycle; a missing year or day takes its default first."""
    return df.fillna({"year": EPOCH_YEAR, "day": 0}).withColumns(calendar_columns())


def add_stateless(df: DataFrame) -> DataFrame:
    """Logs, then ratios of the clamped values, then the calendar."""
    return df.transform(add_logs).transform(add_ratios).transform(add_calendar)


def drop_unmodelled(df: DataFrame) -> DataFrame:
    return df.drop(*UNMODELLED_COLUMNS)


def align(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS), keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's columns in its order, after any in ``keep``.

    Columns that are absent, and values that are null (a year the state has never seen),
    become 0.0.
    """
    have = set(df.columns)
    return df.select(
        *keep,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in have else F.lit(0.0).alias(c)
          for c in columns],
    )


def feature_columns(df: DataFrame) -> list[str]:
    """The model inputs of a feature table: everything but the target."""
    if TARGET not in df.columns:
        raise ValueError(f"Column '{TARGET}' is missing from the feature table.")
    return [c for c in df.columns if c != TARGET]
