"""Vector columns as rows of whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector is there, not empty, and all its entries are there and finite."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


def grid(vector: str, scale: int) -> Column:
    """floor(scale * entry) of every entry, as long; beyond a long the nearest one."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)))


def width(df: DataFrame, column: str) -> int:
    """The length that all vectors share, 0 without rows; an error where lengths differ."""
    low, high = df.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if low != high:
        raise ValueError(f"vectors of {low} to {high} entries: all must have the same number")
    return low or 0


def matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as rows of 64-bit numbers."""
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(len(column), -1)
