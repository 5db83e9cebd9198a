"""Reproducible pseudo-randomness from row content.

``rand(seed)`` depends on how rows are spread over partitions, and a retried task
may see other numbers. A hash of the row key does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8


def order_hash(key: Sequence[str | Column], seed: int) -> Column:
    """Hex digest that puts rows in a fixed, shuffled order."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(":", *texts, F.lit(str(seed))))


def uniform(key: Sequence[str | Column], seed: int) -> Column:
    """A number in [0, 1) from the leading hex digits of the hash."""
    digits = F.substring(order_hash(key, seed), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**HEX_DIGITS)


def below(key: Sequence[str | Column], seed: int, bound: Column) -> Column:
    """A whole number in [0, bound), near enough evenly spread for any bound below 2**50."""
    return F.conv(F.substring(order_hash(key, seed), 1, 15), 16, 10).cast("long") % bound
