"""Every operator as a query over the order and event tables.

Derived tables that a query passes over several times are written once to the shared
folder first. Computed doubles are rounded, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import alerts, clean, drift, features, growing, metrics, model, moments, observed, profile, requests, runs, sampling, zscore
from riskloom.plans import stages
from riskloom.schemas import DECISION_THRESHOLD, EPOCH_YEAR, FEATURE_COLUMNS, MONITORED_FEATURES, NUM_FOLDS, TARGET
from riskloom.session import at_rest, new_path
from riskloom.sources import json_array, star, tables
from riskloom.streaming import counters, live_drift, monitor, scoring, transitions

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
#: Cross-validated scores of the noisy label: 5 of 100 rows are wrong, so none can stay above the second.
LEARNED = (0.8, 0.975)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(f.name, DIGITS).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema
    ])


def staged_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_rest(star.addr(spark, sf_dir), "addr")


def balanced(spark: SparkSession, sf_dir: str, source=star.addr) -> DataFrame:
    labelled = clean.binarise(clean.fill_numeric(at_rest(source(spark, sf_dir), "raw")))
    return clean.balance(labelled, star.ROW_ID)


# Sources and cleaning


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows out to CSV with an unnamed index column, and in again by column name."""
    path = new_path(spark, "csv")
    rows = star.raw(spark, sf_dir)
    indexed = rows.select(F.xxhash64("address").alias("Unnamed: 0"), *rows.columns)
    indexed.write.option("header", True).csv(path)
    out = new_path(spark, "raw")
    tables.write_table(tables.read_raw_csv(spark, path), out)
    return tables.read_table(spark, out)


def live_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live records with missing values out to JSON and in again."""
    path = new_path(spark, "live")
    rows = star.addr_dirty(spark, sf_dir)
    at = F.make_timestamp(F.coalesce("year", F.lit(EPOCH_YEAR)), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("timestamp")
    tables.write_live_json(rows.select(at, *MONITORED_FEATURES), path)
    return tables.read_live_json(spark, path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def live_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live records out to files of one JSON array each, and in again by byte ranges."""
    path = new_path(spark, "live-array")
    rows = star.addr_dirty(spark, sf_dir)
    at = F.make_timestamp(F.coalesce("year", F.lit(EPOCH_YEAR)), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("timestamp")
    json_array.write_json_array(rows.select(at, *MONITORED_FEATURES), path, "income", files=4)
    return tables.read_live_json(spark, path, one_array="ranges").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def clean_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(star.addr_dirty(spark, sf_dir))


def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.class_counts(star.addr_dirty(spark, sf_dir))


def balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_identifier(balanced(spark, sf_dir, star.addr_dirty))


# Features


def log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.addr_dirty(spark, sf_dir).select("address", "income", "weight", "count", "looped")
    return rounded(features.add_logs(rows))


def ratio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.addr_dirty(spark, sf_dir).select("address", "income", "weight", "count", "looped", "neighbors")
    return rounded(features.add_ratios(rows))


def temporal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.add_calendar(star.addr_dirty(spark, sf_dir).select("address", "year", "day")))


def stateless_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.add_stateless(star.addr_dirty(spark, sf_dir)).drop("label"))


def zscore_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(zscore.fit_state(features.add_stateless(clean.fill_numeric(star.addr_dirty(spark, sf_dir)))))


def _fitted(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = new_path(spark, "state")
    tables.save_state(zscore.fit_state(rows), path)
    return tables.load_state(spark, path)


def _loads(rows: DataFrame) -> list[DataFrame]:
    """The rows as three loads that came one after the other."""
    load = F.col("address") % 3
    return [rows.where(load == i) for i in range(3)]


def _moments_of_loads(spark: SparkSession, rows: DataFrame, columns: list[str]) -> DataFrame:
    path = new_path(spark, "load-moments")
    for load in _loads(rows):
        moments.load_moments(load, columns).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def zscore_state_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state from the moments of three loads; equal to the one fitted on all rows."""
    rows = at_rest(features.add_stateless(clean.fill_numeric(star.addr_dirty(spark, sf_dir))), "rows")
    return rounded(moments.zscore_state(_moments_of_loads(spark, rows, ["income"])))


def profile_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile's summary from the moments of three loads; equal to the one of all rows."""
    return rounded(moments.profile_summary(_moments_of_loads(spark, at_rest(star.addr_dirty(spark, sf_dir), "rows"), MONITORED_FEATURES)))


def _dealt_in_loads(spark: SparkSession, sf_dir: str, targets) -> DataFrame:
    rows = star.addr(spark, sf_dir).select("address", clean.is_positive().alias(TARGET), (F.col("address") % 3).alias("load"))
    rows, cuts = at_rest(rows, "rows"), spark.createDataFrame([], growing.CUTS)
    for i, load in enumerate(_loads(rows)):
        cuts = at_rest(cuts.unionByName(growing.deal_load(load, i, cuts, star.ROW_ID, targets)), "cuts")
    return growing.apply_cuts(rows, cuts, star.ROW_ID).drop("load")


def split_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test of three loads, each dealt when it came."""
    dealt = _dealt_in_loads(spark, sf_dir, growing.split_targets())
    return dealt.select("address", TARGET, growing.named_split(F.col("segment")).alias("split"))


def folds_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt_in_loads(spark, sf_dir, growing.fold_targets()).withColumnRenamed("segment", "fold")


def zscore_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_addr(spark, sf_dir).select("address", "year", "income")
    return rounded(zscore.apply_state(rows, _fitted(spark, rows)))


def zscore_apply_unseen_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State from all years but the last, applied to all: the last year has no yearly score."""
    rows = staged_addr(spark, sf_dir).select("address", "year", "income")
    last = rows.agg(F.max("year")).first()[0]
    return rounded(zscore.apply_state(rows, _fitted(spark, rows.where(F.col("year") < last))))


def _feature_table(spark: SparkSession, sf_dir: str, source=star.addr) -> DataFrame:
    stateless = features.add_stateless(balanced(spark, sf_dir, source))
    return zscore.apply_state(stateless, _fitted(spark, stateless))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows to model inputs: clean, balance, stateless features, fitted scores, contract."""
    return rounded(features.align(features.drop_unmodelled(_feature_table(spark, sf_dir)), FEATURE_COLUMNS, [TARGET]))


# Sampling


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.binarise(staged_addr(spark, sf_dir)).select("address", TARGET)
    return sampling.stratified_split(rows, star.ROW_ID)


def kfold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clean.binarise(staged_addr(spark, sf_dir)).select("address", TARGET)
    return sampling.assign_folds(rows, star.ROW_ID)


def bootstrap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_addr(spark, sf_dir).select("address", *MONITORED_FEATURES)
    return sampling.bootstrap(rows, star.ROW_ID)


def inject_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.addr(spark, sf_dir).select("address", *MONITORED_FEATURES)
    return sampling.inject_missing(rows, MONITORED_FEATURES, star.ROW_ID)


# Profile and drift


def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.summarise(star.addr_dirty(spark, sf_dir)))


def profile_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per bin of the reference profile."""
    bins = F.arrays_zip("hist", F.slice("bin_edges", 2, F.size("hist")).alias("upper"))
    found = profile.profile(staged_dirty(spark, sf_dir))
    return rounded(found.select("feature", F.posexplode(bins).alias("bin", "b")).select(
        "feature", "bin", F.col("b.hist").alias("n"), F.col("b.upper").alias("upper_edge")
    ))


def staged_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return at_rest(star.addr_dirty(spark, sf_dir), "addr-dirty")


def _stored_profile(spark: SparkSession, rows: DataFrame) -> DataFrame:
    path = new_path(spark, "profile")
    tables.save_profile(profile.profile(rows), path)
    return tables.load_profile(spark, path)


def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the later years, some values missing, against all rows of the earlier ones."""
    rows = staged_addr(spark, sf_dir)
    reference = _stored_profile(spark, rows.where("year < 1999"))
    live = sampling.inject_missing(rows.where("year >= 1999"), MONITORED_FEATURES, star.ROW_ID)
    return rounded(drift.drift(reference, live))


def drift_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift job: the current run's profile of the balanced table against given live records."""
    at = stages.Layout(new_path(spark, "drift-job"))
    tables.save_profile(profile.profile(at_rest(balanced(spark, sf_dir), "balanced")), at.at("profile"))
    ended = spark.range(1).select(F.current_timestamp()).first()[0]
    tables.log_run(spark, at.at("run-log"), "run-1", stages.Settings().run_name, ended, "", "", "", at.at("profile"))
    records = star.addr_dirty(spark, sf_dir).select(F.current_timestamp().alias("timestamp"), *MONITORED_FEATURES)
    tables.write_live_json(records, at.at("live"))
    return rounded(stages.drift_stage(spark, at, at.at("live")))


def _staged(spark: SparkSession, sf_dir: str) -> stages.Layout:
    """The first stages, run over the raw rows as a CSV; some rows have no label."""
    at, csv = stages.Layout(new_path(spark, "stages")), new_path(spark, "csv")
    unlabelled = F.when(F.col("address").cast("long") % 13 != 0, F.col("label"))
    star.raw(spark, sf_dir).withColumn("label", unlabelled).write.option("header", True).csv(csv)
    stages.ingest(spark, at, csv)
    stages.preprocess_stage(spark, at, stages.Settings(key=star.ROW_ID))
    stages.feature_stage(spark, at)
    return at


def stage_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stages write, from CSV to the feature table."""
    return rounded(features.align(tables.read_table(spark, _staged(spark, sf_dir).at("features")), FEATURE_COLUMNS, [TARGET]))


def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each stage read, that had no label, and that it kept, counted on the way."""
    return observed.newest(tables.read_table(spark, _staged(spark, sf_dir).at(stages.STAGE_ROWS))).drop("ended")


def features_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and split of three loads, added one by one by the load stage."""
    at, raw = stages.Layout(new_path(spark, "stages")), at_rest(star.raw(spark, sf_dir), "raw")
    how = stages.Settings(key=star.ROW_ID)
    for i in range(3):
        csv = new_path(spark, "csv")
        raw.where(F.col("address").cast("long") % 3 == i).write.option("header", True).csv(csv)
        stages.load_stage(spark, at, csv, how)
    found = stages.load_features(spark, at, how)
    return rounded(found.select(F.col("address").cast("long").alias("address"), TARGET, "log_income", "activity_index", "income_z", "income_z_by_year", "split"))


# Classifier metrics


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star.scored(spark, sf_dir)
    return rows.withColumn("pred", (F.col("score") >= DECISION_THRESHOLD).cast("int"))


def confusion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.classification_report(metrics.confusion(_predicted(spark, sf_dir))))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(at_rest(star.scored(spark, sf_dir), "scored")))


def _fold_scores(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Scores per round and side: counted once per fold, then the few cells are shared out over the rounds."""
    cells = metrics.confusion(sampling.assign_folds(rows, ["id"], "y"), ["fold"])
    rounds = F.explode(F.sequence(F.lit(0), F.lit(NUM_FOLDS - 1))).alias("round")
    side = F.when(F.col("round") == F.col("fold"), "test").otherwise("train")
    counts = ["tp", "fp", "fn", "tn"]
    sided = cells.select("fold", *counts, rounds).withColumn("split", side).groupBy("round", "split").agg(
        *[F.sum(c).alias(c) for c in counts]
    )
    return metrics.scores_of(sided, ["round", "split"])


def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = at_rest(_predicted(spark, sf_dir), "predicted")
    return rounded(metrics.summarise_folds(_fold_scores(spark, rows)))


def test_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = at_rest(_predicted(spark, sf_dir), "predicted")
    report = metrics.classification_report(metrics.confusion(rows))
    folds = metrics.summarise_folds(_fold_scores(spark, rows))
    return rounded(metrics.test_summary(report, metrics.roc_auc(rows), folds))


# Requests, runs and alerts


def request_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.request_counters(star.event_log(spark, sf_dir))


def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.latency_histogram(star.event_log(spark, sf_dir)))


def current_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.current_run(star.run_log(spark, sf_dir))


def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = requests.decode(star.requests(spark, sf_dir)).drop("body")
    return decoded.withColumn("missing_fields", F.array_join("missing_fields", ","))


def error_rate_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.error_rate_alert(star.event_log(spark, sf_dir), "1 hour", 0.25, "3 hours")


def down_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.down_alert(star.event_log(spark, sf_dir), "10 minutes")


# Streams


def _untimed(df: DataFrame) -> DataFrame:
    """Window bounds without zone, as the input tables have them."""
    return _unzoned(df, "window_start").drop("window_end")


def stream_request_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _untimed(monitor.request_windows(star.event_stream(spark, sf_dir), "1 hour"))


def stream_latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_untimed(monitor.latency_windows(star.event_stream(spark, sf_dir), "1 hour")))


def stream_error_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that the watermark has passed at the end of the stream."""
    stream = monitor.error_alert_stream(star.event_stream(spark, sf_dir), "1 hour", 0.25, "3 hours")
    return _unzoned(monitor.collect_settled(stream, "error-alerts"), "started", "ended")


def stream_down_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quiet sources that the watermark has passed at the end of the stream."""
    stream = monitor.down_alert_stream(star.event_stream(spark, sf_dir), "10 minutes")
    return _unzoned(monitor.collect_settled(stream, "down-alerts"), "up_from", "down_from")


def _unzoned(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _stream_of(df: DataFrame, name: str) -> DataFrame:
    """Stage a derived table and read it as a stream of files."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of each 90 days of records against the profile of all of them."""
    rows = at_rest(star.live_records(spark, sf_dir), "live")
    stream = _stream_of(rows, "live-stream")
    return rounded(_untimed(monitor.drift_windows(stream, _stored_profile(spark, rows), width="90 days")))


def stream_error_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All episodes at the end of the stream, open ones included."""
    found = monitor.error_alert_states(star.event_stream(spark, sf_dir), "1 hour", 0.25, "3 hours")
    return _unzoned(found, "started", "ended")


def stream_down_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stretches without a healthy sample at the end of the stream, open ones included."""
    return _unzoned(monitor.down_alert_states(star.event_stream(spark, sf_dir), "10 minutes"), "down_from", "down_until")


def stream_error_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings and ends of episodes, each once, as far as the watermark has come."""
    stream = transitions.error_transitions(star.event_stream(spark, sf_dir), "1 hour", 0.25, "3 hours")
    return _unzoned(monitor.collect_settled(stream, "error-transitions"), "started", "moment")


def stream_down_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings and ends of stretches without a healthy sample, each once, as far as the watermark has come."""
    stream = transitions.down_transitions(star.event_stream(spark, sf_dir), "10 minutes")
    return _unzoned(monitor.collect_settled(stream, "down-transitions"), "down_from", "moment")


def _two_deliveries(spark: SparkSession, first: DataFrame, second: DataFrame, run: Callable[[DataFrame], None]) -> None:
    """Start a stream over the first rows; when it is done, start it again over the second ones too."""
    path = new_path(spark, "delivered")
    for part in (first, second):
        part.write.mode("append").parquet(path)
        run(spark.readStream.schema(first.schema).parquet(path))


def stream_late_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests counted once: half of them come after the others, and those others a second time with them."""
    log = at_rest(star.event_log(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "log")
    early, out = log.where("event_id % 2 = 0"), new_path(spark, "totals")
    _two_deliveries(spark, early, log, lambda s: counters.start_counting(counters.once(s, "event_id"), out, "1 hour").awaitTermination())
    found = counters.totals(spark, out).drop("counts", "newest")
    return rounded(_untimed(found))


def stream_drift_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of each 90 days of records; after two thirds of the records a second run with a profile of its own is current."""
    rows, runs_path, out = at_rest(star.dated_addr(spark, sf_dir), "live"), new_path(spark, "run-log"), new_path(spark, "live-drift")
    references = {"run-1": rows, "run-2": rows.where("address % 2 = 0")}
    names = iter(references)

    def next_run(live: DataFrame) -> None:
        run_id, profile_path = next(names), new_path(spark, "profile")
        tables.save_profile(profile.profile(references[run_id]), profile_path)
        ended = spark.range(1).select(F.current_timestamp()).first()[0]
        tables.log_run(spark, runs_path, run_id, "drift", ended, "", "", "", profile_path)
        live_drift.start_drift(live, live_drift.current_profile(spark, runs_path, "drift"), out, width="90 days").awaitTermination()

    _two_deliveries(spark, rows.where("address % 3 <> 0").drop("address"), rows.where("address % 3 = 0").drop("address"), next_run)
    # Means of cents can end in a five after the last digit kept; moved off it, they round alike in any order of adding up.
    found = live_drift.drift_now(spark, out).withColumns({c: F.col(c) + 1e-8 for c in ("mean", "std")})
    return rounded(_untimed(found))


def _model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = features.align(_feature_table(spark, sf_dir, star.addr_separable), FEATURE_COLUMNS, ["address", TARGET])
    return at_rest(table, "features")


def rf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forest fitted on the training split, applied to the test split."""
    split = at_rest(sampling.stratified_split(_model_table(spark, sf_dir), star.ROW_ID), "split")
    fitted = model.fit(split.where("split = 'train'"), FEATURE_COLUMNS)
    return model.score(fitted, split.where("split = 'test'"), ["address", TARGET]).drop("probability")


def rf_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = at_rest(sampling.assign_folds(_model_table(spark, sf_dir), star.ROW_ID), "folds")
    return rounded(model.cross_validate(folded, FEATURE_COLUMNS))


def rf_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a forest learns a noisy label of three features: no score can beat the noise, and few may fall far below it."""
    rows = at_rest(features.align(_feature_table(spark, sf_dir, star.addr_learnable), FEATURE_COLUMNS, ["address", TARGET]), "features")
    folded = at_rest(sampling.assign_folds(rows, star.ROW_ID), "folds")
    scores = metrics.summarise_folds(model.cross_validate(folded, FEATURE_COLUMNS)).where("split = 'test'")
    return scores.select("metric", (F.col("mean") >= LEARNED[0]).alias("learned"), (F.col("mean") <= LEARNED[1]).alias("below_noise"))


def feature_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the feature table: the target, and the inputs in the order that a model takes them."""
    table = features.align(features.drop_unmodelled(_feature_table(spark, sf_dir)), FEATURE_COLUMNS, [TARGET])
    inputs = features.feature_columns(table)
    filled = table.agg(*[F.count(c).alias(c) for c in table.columns])
    roles = [F.struct(F.lit(c).alias("column"), F.lit("target" if c == TARGET else "input").alias("role"),
                      F.lit(inputs.index(c) if c in inputs else None).cast("int").alias("place"), F.col(c).alias("values")) for c in table.columns]
    return filled.select(F.inline(F.array(*roles)))


def rf_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report and area under the curve of a forest on rows it was not fitted on."""
    split = at_rest(sampling.stratified_split(_model_table(spark, sf_dir), star.ROW_ID), "split")
    fitted = model.fit(split.where("split = 'train'"), FEATURE_COLUMNS)
    report, auc = model.evaluate(fitted, split.where("split = 'test'"))
    area = auc.select(F.lit("roc_auc").alias("class"), *[F.lit(None).cast("double").alias(c) for c in ("precision", "recall")], F.col("roc_auc").alias("f1"), F.lit(None).cast("long").alias("support"))
    return rounded(report.unionByName(area))


def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as a stream: rejected with a reason, or scored with the current run's model."""
    stateless = features.add_stateless(balanced(spark, sf_dir, star.addr_separable))
    state_path, model_path, columns_path, log_path = (new_path(spark, n) for n in ("state", "model", "columns", "run-log"))
    tables.save_state(zscore.fit_state(stateless), state_path)
    table = zscore.apply_state(stateless, tables.load_state(spark, state_path))
    training = at_rest(features.align(table, FEATURE_COLUMNS, [TARGET]), "features")
    tables.save_model(model.fit(training, FEATURE_COLUMNS), model_path)
    tables.save_columns(spark, FEATURE_COLUMNS, columns_path)
    ended = spark.range(1).select(F.current_timestamp()).first()[0]
    tables.log_run(spark, log_path, "run-1", "scores", ended, model_path, state_path, columns_path)
    stream = _stream_of(star.requests(spark, sf_dir), "requests")
    scored_path, rejected_path = new_path(spark, "scored"), new_path(spark, "rejected")
    artifacts = scoring.current_artifacts(spark, log_path, "scores")
    scoring.start_scoring(stream, artifacts, scored_path, rejected_path, ["address"]).awaitTermination()
    scored = tables.read_table(spark, scored_path).select("address", "prediction")
    turned_away = tables.read_table(spark, rejected_path).select("address", "reason")
    return scored.unionByName(turned_away, allowMissingColumns=True)


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        csv_ingest, live_json, live_json_array, clean_fill, class_counts, balanced_sample,
        log_features, ratio_features, temporal_features, stateless_features,
        zscore_state, zscore_state_merged, zscore_apply, zscore_apply_unseen_year, feature_table, feature_roles, stage_features, stage_rows, features_of_loads,
        stratified_split, split_of_loads, kfold_assignment, folds_of_loads, bootstrap_sample, inject_missing,
        profile_summary, profile_summary_merged, profile_histogram, drift_psi, drift_job,
        confusion_report, roc_auc, cv_summary, test_summary,
        request_counters, latency_histogram, current_run, request_validation,
        error_rate_alert, down_alert,
        stream_request_metrics, stream_latency_histogram, stream_error_alert, stream_down_alert, stream_error_states, stream_down_states, stream_drift,
        stream_error_transitions, stream_down_transitions, stream_late_counters, stream_drift_runs,
        rf_scores, rf_evaluation, rf_learned, rf_cross_validate, stream_scores,
    )
}
test_summary.__test__ = False  # a query, not a test case
