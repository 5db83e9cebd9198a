"""Drift while live records come in, each against the profile of the run that is current then.

Bin edges belong to a run's profile, so counts of different runs cannot be added. Each micro-batch is binned with the
profile of the run that the log names at that moment and reduced to counts and moments per (run, window, feature, bin); these go
into partitions named by day and batch, which the batch overwrites when it is run again. The index of the windows that
the batch touched is then worked out from all counts of their days, so what is read goes with the days touched and
not with the age of the stream. Records of any age are counted; nothing waits for a watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.drift import bin_live, count_bins, score_bins
from riskloom.operators.runs import resolve_run
from riskloom.schemas import MONITORED_FEATURES
from riskloom.sources.tables import load_profile, load_runs
from riskloom.streaming.sinks import batch_path, checkpoint_of, latest, start

WINDOW = ["window_start", "window_end"]
COUNTS = "run_id string, window_start timestamp, window_end timestamp, feature string, bin int, n long, mean double, var double, day date, batch long"
SCORES = "run_id string, window_start timestamp, window_end timestamp, feature string, missing_ratio double, mean double, std double, psi double, reason string"


@dataclass(frozen=True)
class Reference:
    run_id: str
    profile: DataFrame


def current_profile(spark: SparkSession, runs_path: str, run_name: str) -> Callable[[], Reference]:
    """A function giving the current run and its profile, which is loaded anew only when the run changes."""
    held: list[Reference] = []

    def get() -> Reference:
        runs = load_runs(spark, runs_path)
        run_id = resolve_run(runs, run_name)
        if not held or held[0].run_id != run_id:
            path = runs.where(F.col("run_id") == run_id).first()["profile_path"]
            if not path:
                raise RuntimeError(f"Run '{run_id}' has no profile to compare with.")
            held[:] = [Reference(run_id, load_profile(spark, path))]
        return held[0]

    return get


def counts_path(path: str) -> str:
    return f"{path.rstrip('/')}-counts"


def merged(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts and moments per group from those of its parts; one part per micro-batch that touched the group."""
    gathered = counts.groupBy(*by).agg(F.sum("n").alias("n"), F.collect_list(F.struct("n", "mean", "var")).alias("parts"))

    def added(term: Callable[[Column], Column]) -> Column:
        return F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + p["n"] * F.coalesce(term(p), F.lit(0.0)))

    with_mean = gathered.withColumn("mean", added(lambda p: p["mean"]) / F.col("n"))
    spread = added(lambda p: p["var"] + (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")))
    return with_mean.withColumn("var", spread / F.col("n")).drop("parts")


def start_drift(
    live: DataFrame, reference: Callable[[], Reference], path: str, features: Sequence[str] = tuple(MONITORED_FEATURES),
    width: str = "1 hour", **how,
) -> StreamingQuery:
    """Write the indexes of the windows that each micro-batch touches to its folder under ``path``."""
    spark = live.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = reference()
        binned = bin_live(batch, now.profile, features, keep=["timestamp"])
        counted = count_bins(binned, [F.window("timestamp", width).alias("window")])
        flat = counted.select(F.lit(now.run_id).alias("run_id"), F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "feature", "bin", "n", "mean", "var")
        dated = flat.withColumns({"day": F.to_date("window_start"), "batch": F.lit(batch_id).cast("long")})
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(counts_path(path))
        written = spark.read.schema(COUNTS).parquet(counts_path(path))
        own = written.where(F.col("batch") == batch_id)
        days = [r["day"] for r in own.select("day").distinct().collect()]
        touched = own.where(F.col("day").isin(days)).select(*WINDOW).distinct()
        same_run = written.where(F.col("day").isin(days) & (F.col("run_id") == now.run_id) & (F.col("batch") <= batch_id))
        counts = merged(same_run.join(touched, WINDOW, "left_semi"), [*WINDOW, "feature", "bin"])
        scored = score_bins(counts, now.profile, features, WINDOW).withColumn("run_id", F.lit(now.run_id))
        names = [c.split()[0] for c in SCORES.split(", ")]
        scored.select(*names).write.mode("overwrite").parquet(batch_path(path, batch_id))

    return start(live, handle, "append", **{"checkpoint": checkpoint_of(path), **how})


def drift_now(spark: SparkSession, path: str) -> DataFrame:
    """The newest index of every run, window and feature."""
    schema = spark.createDataFrame([], SCORES).schema
    return latest(spark, path, schema, ["run_id", *WINDOW, "feature"])
