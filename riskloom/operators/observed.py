"""Row counts taken on the way: the job that reads or writes the rows counts them too, so they cost no pass of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

COUNTS = "stage string, read long, unlabelled long, kept long, ended timestamp"


class RowCounts:
    """What one stage read, how many of these rows had no label, and what it kept.

    ``at_source`` and ``at_end`` give their input back, to be used instead of it. The counts are those of the first job over
    each; ``table`` waits for it. A count that was never asked for is null. Use a session of its own (``session.beside``).
    """

    def __init__(self, stage: str):
        self.stage, self.seen = stage, {}

    def _observe(self, df: DataFrame, **counts: Column) -> DataFrame:
        observation = Observation(f"{self.stage}-{'-'.join(counts)}")
        self.seen.update(dict.fromkeys(counts, observation))
        return df.observe(observation, *[c.alias(name) for name, c in counts.items()])

    def at_source(self, df: DataFrame, label: str | None = None) -> DataFrame:
        counts = {"read": F.count(F.lit(1))}
        if label:
            counts["unlabelled"] = F.count_if(F.col(label).isNull())
        return self._observe(df, **counts)

    def at_end(self, df: DataFrame) -> DataFrame:
        return self._observe(df, kept=F.count(F.lit(1)))

    def table(self, spark) -> DataFrame:
        """One row, once the jobs are done."""
        values = {name: observation.get[name] for name, observation in self.seen.items()}
        row = (self.stage, values.get("read"), values.get("unlabelled"), values.get("kept"))
        return spark.createDataFrame([row], COUNTS.rsplit(", ", 1)[0]).withColumn("ended", F.current_timestamp())


def newest(counts: DataFrame) -> DataFrame:
    """The counts of the last run of every stage."""
    last = F.max_by(F.struct("read", "unlabelled", "kept", "ended"), "ended").alias("last")
    return counts.groupBy("stage").agg(last).select("stage", "last.*")
