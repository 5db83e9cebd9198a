"""Streams against the batch operators on the same rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import alerts, metrics
from riskloom.operators.drift import drift
from riskloom.operators.features import add_stateless
from riskloom.operators.model import ForestSettings, fit
from riskloom.operators.profile import profile
from riskloom.operators.requests import accepted, decode
from riskloom.operators.zscore import apply_state, fit_state
from riskloom.schemas import FEATURE_COLUMNS, TARGET
from riskloom.session import at_rest, new_path
from riskloom.sources import star, tables
from riskloom.streaming import monitor, scoring, sinks

SF_DIR = "/root/testdata/sf0.001"


def in_files(spark, df, files=4, order="ts"):
    """Write rows as several files in event order, and read one file per micro-batch."""
    path = new_path(spark, "in")
    parts = at_rest(df.withColumn("_file", F.ntile(files).over(Window.orderBy(order))), "parts")
    for i in range(files):
        parts.where(F.col("_file") == i + 1).drop("_file").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def log(spark):
    return at_rest(star.event_log(spark, SF_DIR).withColumn("ts", F.col("ts").cast("timestamp")), "log")


def test_request_windows_over_many_batches(spark, log):
    got = monitor.request_windows(in_files(spark, log), "6 hours")
    expected = log.groupBy(F.window("ts", "6 hours").alias("w")).agg(*metrics.request_aggregates())
    expected = expected.select("w.start", "w.end", "requests", "errors", "ransomware", "clean")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_latency_windows_add_up(spark, log):
    got = monitor.latency_windows(in_files(spark, log), "1 day")
    whole = {r.le: r.cumulative_count for r in metrics.latency_histogram(log).collect()}
    assert {r.le: r.n for r in got.groupBy("le").agg(F.sum("cumulative_count").alias("n")).collect()} == whole


def test_late_rows_are_dropped(spark):
    """The watermark a batch sets takes hold for the rows of the batch after next."""
    base = datetime(2024, 1, 1, 12)
    rows = [(base + timedelta(minutes=m), 0, "clean", 0.1) for m in (0, 1, 300, 301, 2)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "event_id int, ts timestamp, is_error int, prediction string, latency_seconds double")
    path = new_path(spark, "late")
    for i in range(5):
        df.where(F.col("event_id") == i).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got, out = monitor.windowed_requests(stream, "1 hour", "10 minutes"), new_path(spark, "windows")
    newest = monitor.collect_windows(got, ["window_start", "window_end"], "", out)
    assert newest.agg(F.sum("requests")).first()[0] == 4
    assert spark.read.parquet(f"{out}-late").agg(F.sum("dropped")).first()[0] == 1


def test_drift_of_one_window_equals_batch(spark):
    rows = at_rest(star.live_records(spark, SF_DIR), "live")
    reference = at_rest(profile(rows), "profile")
    stream = in_files(spark, rows, order="timestamp")
    got = monitor.drift_windows(stream, reference, width="36500 days", lateness="1 day")
    expected = {r.feature: r for r in drift(reference, rows).collect()}
    for row in got.collect():
        assert row.psi == pytest.approx(expected[row.feature].psi, abs=1e-12)
        assert row["mean"] == pytest.approx(expected[row.feature]["mean"])
        assert row["std"] == pytest.approx(expected[row.feature]["std"])


def test_error_alerts_come_out_once_passed(spark, log):
    stream = monitor.error_alert_stream(in_files(spark, log), "6 hours", 0.2, "12 hours")
    path = new_path(spark, "alerts")
    sinks.start_appends(stream, path).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(path).drop("batch").select(*stream.columns).collect()}
    batch = alerts.error_rate_alert(log, "6 hours", 0.2, "12 hours").select(*stream.columns)
    expected = {tuple(r) for r in batch.collect()}
    last = log.agg(F.max("ts")).first()[0]
    settled = {r for r in expected if r[stream.columns.index("ended")] < last - timedelta(days=1)}
    assert settled and settled <= got <= expected


def test_quiet_sources_on_a_stream(spark, log):
    stream = monitor.down_alert_stream(in_files(spark, log), "3 hours")
    path = new_path(spark, "down")
    sinks.start_appends(stream, path).awaitTermination()
    got = {(r.source, r.down_from) for r in spark.read.parquet(path).collect()}
    expected = {(r.source, r.down_from) for r in alerts.down_alert(log, "3 hours").collect() if r.state == "closed"}
    healthy = {(r.source, r.ts) for r in log.where("is_error = 0").select("source", "ts").collect()}
    expected &= healthy  # sessions know nothing of the time before the first of them
    ends = {(r.source, r.t) for r in log.where("is_error = 0").groupBy("source").agg(F.max("ts").alias("t")).collect()}
    last = log.agg(F.max("ts")).first()[0]
    settled = {x for x in expected if x[1] < last - timedelta(hours=12)}
    assert settled and settled <= got <= expected | ends


@pytest.fixture(scope="module")
def artifacts(spark):
    rows = at_rest(add_stateless(star.addr(spark, SF_DIR).withColumn(TARGET, (F.col("label") != "white").cast("int"))), "rows")
    state = at_rest(fit_state(rows), "state")
    table = at_rest(apply_state(rows, state), "table")
    return state, [fit(table, FEATURE_COLUMNS, ForestSettings(3, 4, seed)) for seed in (1, 2)]


def test_stream_scores_equal_batch_scores(spark, artifacts):
    state, (model, _) = artifacts
    bodies = at_rest(star.requests(spark, SF_DIR), "requests")
    stream = scoring.score_stream(in_files(spark, bodies, order="address"), state, model, ["address"])
    path = new_path(spark, "scored")
    sinks.start_appends(stream, path).awaitTermination()
    batch = scoring.score_accepted(accepted(decode(bodies)), state, model, ["address"])
    got = spark.read.parquet(path).select(*batch.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert batch.count() > 0


def test_retrained_run_is_picked_up_between_batches(spark, artifacts):
    """Features and training run again between two micro-batches: each batch equals the batch result of its run."""
    state, models = artifacts
    other = at_rest(state.withColumn("mean", F.col("mean") + 5), "state")
    runs, bodies = new_path(spark, "runs"), at_rest(star.requests(spark, SF_DIR), "requests")

    def publish(run_id, day, fitted, own_state):
        paths = [new_path(spark, n) for n in ("model", "state", "columns")]
        tables.save_model(fitted, paths[0])
        tables.save_state(own_state, paths[1])
        tables.save_columns(spark, FEATURE_COLUMNS, paths[2])
        tables.log_run(spark, runs, run_id, "r", datetime(2024, 1, day), *paths)

    publish("first", 1, models[0], state)
    held = scoring.current_artifacts(spark, runs, "r")
    seen = []

    def artifacts_then_retrain():
        now = held()
        seen.append(now.run_id)
        if len(seen) == 1:
            assert held() is now  # unchanged runs load nothing
            publish("second", 2, models[1], other)
        return now

    stream = in_files(spark, bodies, 2, "address")
    scored, rejected = new_path(spark, "scored"), new_path(spark, "rejected")
    scoring.start_scoring(stream, artifacts_then_retrain, scored, rejected, ["address"]).awaitTermination()
    assert seen == ["first", "second"]
    got = spark.read.parquet(scored)
    for run_id, fitted, own_state in (("first", models[0], state), ("second", models[1], other)):
        own = got.where(F.col("run_id") == run_id)
        batch = scoring.score_accepted(accepted(decode(bodies)), own_state, fitted, ["address"])
        wanted = batch.join(own.select("address"), "address")
        assert sorted(map(tuple, own.select(*batch.columns).collect())) == sorted(map(tuple, wanted.collect())) != []
    assert got.count() + spark.read.parquet(rejected).count() == bodies.count()
    assert {r.reason for r in spark.read.parquet(rejected).select("reason").distinct().collect()} == {"invalid_json", "missing_fields"}


def test_model_that_takes_other_columns_is_refused(spark, artifacts):
    state, models = artifacts
    paths = [new_path(spark, n) for n in ("model", "state", "columns", "runs")]
    tables.save_model(models[0], paths[0])
    tables.save_state(state, paths[1])
    tables.save_columns(spark, FEATURE_COLUMNS[:-1], paths[2])
    tables.log_run(spark, paths[3], "one", "r", datetime(2024, 1, 1), *paths[:3])
    with pytest.raises(RuntimeError, match="takes"):
        scoring.current_artifacts(spark, paths[3], "r")()


def test_stream_goes_on_after_a_restart(spark, log):
    """Two starts over a growing input give what one start gives; folders can be folded in between."""
    path, out = new_path(spark, "in"), new_path(spark, "out")
    half = log.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    keys = ["window_start", "window_end"]
    for part in (log.where(F.col("ts") <= half), log.where(F.col("ts") > half)):
        part.coalesce(1).write.mode("append").parquet(path)
        stream = monitor.windowed_requests(spark.readStream.schema(log.schema).parquet(path), "6 hours")
        sinks.start_versions(stream, out).awaitTermination()
    whole = monitor.request_windows(spark.readStream.schema(log.schema).parquet(path), "6 hours")
    expected = sorted(map(tuple, whole.select(*stream.columns).collect()))
    newest = lambda: sorted(map(tuple, sinks.latest(spark, out, stream.schema, keys).select(*stream.columns).collect()))
    assert newest() == expected
    batches = [r.batch for r in spark.read.parquet(out).select("batch").distinct().collect()]
    assert len(batches) > 1
    sinks.compact(spark, out, stream.schema, keys, max(batches))
    assert newest() == expected and spark.read.parquet(out).select("batch").distinct().count() == 1


def test_sessions_are_merged_before_the_shuffle(spark, log):
    before = spark.conf.get(sinks.LOCAL_SESSIONS)
    stream = monitor.down_alert_stream(in_files(spark, log), "3 hours")
    query = sinks.start_appends(stream, new_path(spark, "down"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "MergingSessions" in plan.split("Exchange hashpartitioning(source")[-1]
    assert spark.conf.get(sinks.LOCAL_SESSIONS) == before


def test_batch_run_again_overwrites_itself(spark):
    path = new_path(spark, "again")
    write = lambda df, i: df.write.mode("overwrite").parquet(sinks.batch_path(path, i))
    for _ in range(2):
        write(spark.range(5), 0)
    assert spark.read.parquet(path).count() == 5


def test_request_values_survive_json(spark):
    body = json.dumps({"year": 2012, "day": 3, "length": 1, "weight": 1e-9, "count": 1, "looped": 0, "neighbors": 1, "income": 1e20})
    row = accepted(decode(spark.createDataFrame([(body,)], "body string"))).first()
    assert row.weight == 1e-9 and row.income == 1e20
