"""The stages, each from tables at rest to tables at rest; the last three are streams."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import growing, moments
from riskloom.operators.clean import ROW_KEY, balance, binarise, fill_numeric, preprocess
from riskloom.operators.drift import drift
from riskloom.operators.features import add_stateless, drop_unmodelled, feature_columns
from riskloom.operators.model import ForestSettings, Trained, train
from riskloom.operators.observed import RowCounts, newest
from riskloom.operators.profile import profile
from riskloom.operators.runs import resolve_run
from riskloom.operators.zscore import apply_state, fit_state
from riskloom.schemas import LIVE, MONITORED_FEATURES, NUM_FOLDS, PREDICTION_LOG, RAW, RUN_NAME, SEED, TEST_FRACTION
from riskloom.session import at_rest, beside
from riskloom.sources import tables
from riskloom.streaming import counters, live_drift, monitor, scoring, transitions
from riskloom.streaming.sinks import LateRows, start_appends, start_versions

#: Rows read, without a label, and kept, one row per run of a stage.
STAGE_ROWS = "stage-rows"


@dataclass(frozen=True)
class Layout:
    """Where the tables of one deployment live, on storage all executors share."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Settings:
    key: Sequence[str] = tuple(ROW_KEY)
    seed: int = SEED
    test_fraction: float = TEST_FRACTION
    folds: int = NUM_FOLDS
    features: Sequence[str] = tuple(MONITORED_FEATURES)
    run_name: str = RUN_NAME
    forest: ForestSettings = field(default_factory=ForestSettings)


def _write_counted(spark: SparkSession, at: Layout, rows: RowCounts, df: DataFrame, name: str) -> None:
    """Write a stage's table, then what it read and kept."""
    tables.write_table(rows.at_end(df), at.at(name))
    tables.write_table(rows.table(spark), at.at(STAGE_ROWS), "append")


def ingest(spark: SparkSession, at: Layout, csv_path: str) -> None:
    spark, rows = beside(spark), RowCounts("ingest")
    _write_counted(spark, at, rows, rows.at_source(tables.read_raw_csv(spark, csv_path), "label"), "raw")


def preprocess_stage(spark: SparkSession, at: Layout, how: Settings = Settings()) -> None:
    spark, rows = beside(spark), RowCounts("preprocess")
    raw = rows.at_source(tables.read_table(spark, at.at("raw"), RAW), "label")
    _write_counted(spark, at, rows, preprocess(raw, how.key, how.seed), "preprocessed")


def feature_stage(spark: SparkSession, at: Layout) -> None:
    """Save the fitted state first, then join it back from rest: income and year are read twice, the rest once.

    The state lies beside the features it made; training copies it to the run, from where streams load it.
    """
    spark, rows = beside(spark), RowCounts("features")
    stateless = add_stateless(rows.at_source(tables.read_table(spark, at.at("preprocessed"))))
    tables.save_state(fit_state(stateless), at.at("features-state"))
    featured = apply_state(stateless, tables.load_state(spark, at.at("features-state")))
    _write_counted(spark, at, rows, drop_unmodelled(featured), "features")


def load_stage(spark: SparkSession, at: Layout, csv_path: str, how: Settings = Settings()) -> int:
    """Add a CSV to the loads that are there: only its own rows are read, and nothing is written anew.

    The load is balanced by itself, its rows are dealt to train and test for good, and its moments go beside those of the
    loads before. Returns its number. A load cut off half-way has no cuts yet: it is written over by the next try.
    """
    cuts_path = at.at("load-cuts")
    cuts = tables.read_table(spark, cuts_path, growing.schema()) if tables.exists(spark, cuts_path) else spark.createDataFrame([], growing.CUTS)
    load = (cuts.agg(F.max("load")).first()[0] or 0) + 1
    # The text is parsed once; the passes that look for the cuts read columns.
    labelled = at_rest(binarise(fill_numeric(tables.read_raw_csv(spark, csv_path))), "labelled")
    balanced = at_rest(balance(labelled, how.key, how.seed), "balanced")
    stateless = add_stateless(balanced)
    tables.write_table(stateless, at.at(f"loads/load={load}"))
    tables.write_table(moments.load_moments(stateless, ["income", *how.features]), at.at(f"load-moments/load={load}"))
    dealt = growing.deal_load(balanced, load, cuts, how.key, growing.split_targets(how.test_fraction), seed=how.seed)
    tables.write_table(dealt, cuts_path, "append")
    return load


def load_features(spark: SparkSession, at: Layout, how: Settings = Settings()) -> DataFrame:
    """Key, target, features and split of the rows of all loads; the scores are those of the state of their union."""
    cuts = tables.read_table(spark, at.at("load-cuts"), growing.schema())
    done = F.col("load").isin([r["load"] for r in cuts.select("load").distinct().collect()])
    parts = spark.read.parquet(at.at("load-moments")).where(done)
    tables.save_state(moments.zscore_state(parts), at.at("load-state"))
    rows = growing.apply_cuts(spark.read.parquet(at.at("loads")).where(done), cuts, how.key, into="segment", seed=how.seed)
    scored = apply_state(rows, tables.load_state(spark, at.at("load-state")))
    return scored.withColumn("split", growing.named_split(F.col("segment"))).drop("segment")


def training_stage(spark: SparkSession, at: Layout, how: Settings = Settings()) -> Trained:
    """Train, evaluate, and save model, state, columns, metrics and profile under the run; it is logged last."""
    run_id = uuid.uuid4().hex
    of_run = Layout(at.at(f"runs/{run_id}"))
    tables.save_state(tables.load_state(spark, at.at("features-state")), of_run.at("state"))
    features = tables.read_table(spark, at.at("features"))
    columns = feature_columns(features)
    trained = train(features, columns, columns, how.forest, how.test_fraction, how.folds, how.seed)
    tables.save_columns(spark, columns, of_run.at("feature-columns"))
    tables.save_model(trained.model, of_run.at("model"))
    for name, table in {
        "fold-scores": trained.fold_scores, "report": trained.report, "summary": trained.summary,
    }.items():
        tables.write_table(table, of_run.at(name))
    tables.write_table(newest(tables.read_table(spark, at.at(STAGE_ROWS))), of_run.at(STAGE_ROWS))
    reference = profile(tables.read_table(spark, at.at("preprocessed")), how.features)
    tables.save_profile(reference, of_run.at("profile"))
    ended = datetime.now(timezone.utc)
    paths = [of_run.at(x) for x in ("model", "state", "feature-columns", "profile")]
    tables.log_run(spark, at.at("run-log"), run_id, how.run_name, ended, *paths)
    return trained


def drift_stage(spark: SparkSession, at: Layout, live_path: str, how: Settings = Settings()) -> DataFrame:
    """Compare given live records with the profile of the current run; the result is also written as a table."""
    runs = tables.load_runs(spark, at.at("run-log"))
    run_id = resolve_run(runs, how.run_name)
    profile_path = runs.where(F.col("run_id") == run_id).first()["profile_path"]
    found = drift(tables.load_profile(spark, profile_path), tables.read_live_json(spark, live_path), how.features)
    tables.write_table(found, at.at("drift"))
    return tables.read_table(spark, at.at("drift"))


def score_stage(spark: SparkSession, at: Layout, requests_path: str, how: Settings = Settings(), **trigger) -> None:
    """Score JSON requests as they come, with the run that is current at each micro-batch.

    A body may name its request in ``request_id``; one delivered again is scored once.
    """
    bodies = spark.readStream.text(requests_path).withColumnRenamed("value", "body")
    named = bodies.withColumn("request_id", F.get_json_object("body", "$.request_id"))
    artifacts = scoring.current_artifacts(spark, at.at("run-log"), how.run_name)
    scoring.start_scoring(counters.once(named, "request_id").select("body"), artifacts, at.at("scored"), at.at("rejected"), ["body"], **trigger).awaitTermination()


def monitor_stage(spark: SparkSession, at: Layout, log_path: str, **trigger) -> None:
    """Request counters, alerts, and the windows that alert states are read from.

    ``request-totals`` counts every request once, late ones too. ``error-transitions`` and ``down-transitions`` get a
    row when an alert opens and one when it ends. Rows that come too late for windows and alerts are counted per micro-batch.
    """
    log = spark.readStream.schema(PREDICTION_LOG).parquet(log_path)
    windows = {
        "request-windows": monitor.windowed_requests(log), "latency-windows": monitor.windowed_latency(log),
        "error-counts": monitor.windowed_errors(log), "sample-windows": monitor.windowed_samples(log),
    }
    raised = {"error-transitions": transitions.error_transitions(log), "down-transitions": transitions.down_transitions(log)}
    names = [*windows, *raised]
    late = LateRows(spark, [at.at(name) for name in names])
    spark.streams.addListener(late)
    running = [start_versions(stream, at.at(name), name=at.at(name), **trigger) for name, stream in windows.items()]
    running += [start_appends(stream, at.at(name), name=at.at(name), **trigger) for name, stream in raised.items()]
    running.append(counters.start_counting(counters.once(log, "event_id"), at.at("request-totals"), **trigger))
    for query in running:
        query.awaitTermination()
    late.finish(len(names))


def watch_stage(spark: SparkSession, at: Layout, live_path: str, how: Settings = Settings(), **trigger) -> None:
    """Drift of live records per hour while they come in, against the profile of the run that is current then."""
    live = spark.readStream.schema(LIVE).json(live_path)
    reference = live_drift.current_profile(spark, at.at("run-log"), how.run_name)
    live_drift.start_drift(live, reference, at.at("live-drift"), how.features, **trigger).awaitTermination()
