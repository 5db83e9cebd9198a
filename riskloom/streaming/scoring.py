"""Score a stream of JSON requests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.features import add_stateless
from riskloom.operators.model import contract, score
from riskloom.operators.requests import accepted, decode, rejected
from riskloom.operators.runs import resolve_run
from riskloom.operators.zscore import apply_state
from riskloom.sources.tables import load_columns, load_model, load_runs, load_state
from riskloom.streaming.sinks import batch_path, checkpoint_of, start


def score_accepted(requests: DataFrame, state: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """Features, state and model on decoded requests, for batch and stream alike."""
    featured = apply_state(add_stateless(requests), state)
    return score(model, featured, keep=keep).drop("pred")


def score_stream(
    requests: DataFrame, state: DataFrame, model: PipelineModel, keep: Sequence[str] = (), body: str = "body"
) -> DataFrame:
    """Stateless scoring of all valid requests (append mode)."""
    return score_accepted(accepted(decode(requests, body)), state, model, keep)


@dataclass(frozen=True)
class Artifacts:
    run_id: str
    state: DataFrame
    model: PipelineModel
    columns: tuple[str, ...]


def current_artifacts(spark, runs_path: str, run_name: str) -> Callable[[], Artifacts]:
    """A function giving the current run's model, state and columns, all named by one row of the run log.

    They are loaded anew only when the run changes. A model that takes other columns than its run says is refused.
    """
    held: list[Artifacts] = []

    def get() -> Artifacts:
        runs = load_runs(spark, runs_path)
        run_id = resolve_run(runs, run_name)
        if not held or held[0].run_id != run_id:
            at = runs.where(F.col("run_id") == run_id).first()
            model, columns = load_model(at["model_path"]), load_columns(spark, at["columns_path"])
            if contract(model) != columns:
                raise RuntimeError(f"The model of run '{run_id}' takes {contract(model)}; the run says {columns}.")
            held[:] = [Artifacts(run_id, load_state(spark, at["state_path"]), model, tuple(columns))]
        return held[0]

    return get


def start_scoring(
    requests: DataFrame, artifacts: Callable[[], Artifacts], scored_path: str, rejected_path: str,
    keep: Sequence[str] = (), body: str = "body", **how,
) -> StreamingQuery:
    """Write scored and rejected requests to two tables, with the run current at each micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = artifacts()
        decoded = decode(batch, body).persist()
        try:
            done = score_accepted(accepted(decoded), now.state, now.model, keep)
            done.withColumn("run_id", F.lit(now.run_id)).write.mode("overwrite").parquet(batch_path(scored_path, batch_id))
            rejected(decoded).write.mode("overwrite").parquet(batch_path(rejected_path, batch_id))
        finally:
            decoded.unpersist()

    return start(requests, handle, "append", **{"checkpoint": checkpoint_of(scored_path), **how})
