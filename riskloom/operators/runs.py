"""Which training run is current."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current_run(log: DataFrame) -> DataFrame:
    """Per run name: the single unfinished run, else the one that ended last, else a reason.

    Runs that ended at the same time are told apart by the larger id.
    """
    open_run = F.col("end_time").isNull()
    per_name = log.groupBy("run_name").agg(
        F.count_if(open_run).alias("unfinished"),
        F.max(F.when(open_run, F.col("run_id"))).alias("open_id"),
        F.max_by("run_id", F.struct("end_time", "run_id")).alias("last_id"),
    )
    return per_name.select(
        "run_name",
        F.when(F.col("unfinished") == 1, F.col("open_id"))
        .when(F.col("unfinished") == 0, F.col("last_id")).alias("run_id"),
        F.col("unfinished"),
        F.when(F.col("unfinished") > 1, "multiple_unfinished_runs").alias("reason"),
    )


def resolve_run(log: DataFrame, run_name: str) -> str:
    """The current run id of one name; an error when there is none or more than one candidate."""
    found = current_run(log.where(F.col("run_name") == run_name)).first()
    if found is None:
        raise RuntimeError(f"No run is named '{run_name}'.")
    if found["reason"]:
        raise RuntimeError(f"Run '{run_name}' has {found['unfinished']} unfinished runs; expected at most one.")
    return found["run_id"]
