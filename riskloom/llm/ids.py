"""Ids of any type for operators that work on numbers."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from riskloom.session import at_rest


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id as a number and text of every row, and the table of (number, id); numbers keep the order of the ids.

    Ids are sorted over all tasks and numbered where they are. A null id stays null.
    """
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    ordered = plain.select(F.col("doc_id").alias("id")).where("id IS NOT NULL").distinct().orderBy("id")
    names = at_rest(ordered.select(F.monotonically_increasing_id().alias("number"), "id"), "names")
    rows = plain.join(names, plain["doc_id"] == names["id"], "left").select(F.col("number").alias("doc_id"), "text")
    return at_rest(rows, "numbered"), names


def of_any_type(*columns: str) -> Callable:
    """For an operator over (doc_id, text) rows that takes long ids: other ids go in as numbers, ``columns`` come out as ids."""

    def around(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(work)
        def over(docs: DataFrame, *args, **settings) -> DataFrame:
            kind = docs.schema["doc_id"].dataType
            if isinstance(kind, LongType):
                return work(docs, *args, **settings)
            if isinstance(kind, IntegralType):
                out = work(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), *args, **settings)
                return out.withColumns({c: F.col(c).cast(kind) for c in columns})
            rows, names = numbered(docs)
            out = work(rows, *args, **settings)
            for column in columns:
                known = names.select(F.col("number").alias("_number"), F.col("id").alias("_id"))
                named = out.join(known, out[column] == known["_number"], "left")
                out = named.select(*[F.col("_id").alias(c) if c == column else F.col(c) for c in out.columns])
            return out

        return over

    return around
