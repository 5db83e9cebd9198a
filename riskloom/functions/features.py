"""Column expressions for the stateless features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.schemas import DAYS_PER_YEAR, EPOCH_YEAR


def nonnegative(name: str) -> Column:
    """The value, with null and negatives as 0.0."""
    return F.greatest(F.coalesce(F.col(name), F.lit(0.0)), F.lit(0.0))


def ratio(top: Column, bottom: str) -> Column:
    """``top / (bottom + 1)``, null where the divisor is zero."""
    return F.try_divide(top, F.col(bottom) + 1)


def ratio_columns() -> dict[str, Column]:
    return {
        "activity_index": ratio(F.col("count") + F.col("neighbors"), "looped"),
        "weight_to_count": ratio(F.col("weight"), "count"),
        "income_per_neighbor": ratio(F.col("income"), "neighbors"),
    }


def calendar_columns() -> dict[str, Column]:
    turn = F.col("day") * (2 * F.pi() / DAYS_PER_YEAR)
    return {
        "days_since_2009": (F.col("year") - EPOCH_YEAR) * DAYS_PER_YEAR + F.col("day"),
        "sin_day": F.sin(turn),
        "cos_day": F.cos(turn),
    }


def present(value: Column) -> Column:
    """The value as double, with NaN as null."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)
