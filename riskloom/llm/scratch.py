"""Working tables that go when they are no longer needed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import new_path, remove


class Scratch:
    """Named tables under the shared folder; writing a name anew deletes the table that had it.

    A table is deleted only after its successor is written whole, so a lost executor never needs it again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def rest(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                remove(self.spark, self.paths.pop(name))

    def drop_all_but(self, *names: str) -> None:
        self.drop(*[n for n in self.paths if n not in names])
