"""Counters that lose no request, drift over a change of runs, and late rows of streams that were restarted."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators import metrics
from riskloom.operators.drift import drift
from riskloom.operators.profile import profile
from riskloom.schemas import PREDICTION_LOG
from riskloom.session import at_rest, new_path
from riskloom.sources import star, tables
from riskloom.streaming import counters, live_drift, monitor, sinks

SF_DIR = "/root/testdata/sf0.001"
WINDOW = ["window_start", "window_end"]


@pytest.fixture(scope="module")
def log(spark):
    rows = star.event_log(spark, SF_DIR)
    return at_rest(rows.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTION_LOG]), "log")


def batch_windows(log, width):
    counted = log.groupBy(F.window("ts", width).alias("w")).agg(*metrics.request_aggregates())
    return sorted(map(tuple, counted.select("w.start", "w.end", "requests", "errors", "ransomware", "clean").collect()))


def in_parts(spark, rows, n):
    """Files of a shuffled log, one for each micro-batch."""
    path = new_path(spark, "in")
    for i in range(n):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(n)) == i).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_of(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_shuffled_and_redelivered_requests_count_once(spark, log):
    """Months of lateness, every request twice, and a restart: the totals are those of the batch."""
    path, out = in_parts(spark, log, 3), new_path(spark, "totals")
    for _ in range(2):
        counters.start_counting(counters.once(stream_of(spark, log.schema, path), "event_id"), out, "6 hours").awaitTermination()
        log.coalesce(1).write.mode("append").parquet(path)
    found = counters.request_totals(spark, out)
    assert sorted(map(tuple, found.drop("late").select(*WINDOW, "requests", "errors", "ransomware", "clean").collect())) == batch_windows(log, "6 hours")
    assert 0 < found.agg(F.sum("late")).first()[0] < log.count()
    whole = {r.le: r.cumulative_count for r in metrics.latency_histogram(log).collect()}
    assert {r.le: r.n for r in counters.latency_totals(spark, out).groupBy("le").agg(F.sum("cumulative_count").alias("n")).collect()} == whole


def test_late_rows_are_those_behind_the_mark_before(spark):
    base = datetime(2024, 1, 1, 12)
    rows = [(i, base + timedelta(minutes=m), 1, 0, "clean", 0.1) for i, m in enumerate((0, 300, 2, 301, 3, 240))]
    df = spark.createDataFrame(rows, PREDICTION_LOG)
    path, out = new_path(spark, "in"), new_path(spark, "totals")
    for i in range(6):
        df.where(F.col("event_id") == i).coalesce(1).write.mode("append").parquet(path)
        counters.start_counting(spark.readStream.schema(df.schema).parquet(path), out, "1 hour").awaitTermination()
    assert sorted((r.window_start.hour, r.requests, r.late) for r in counters.request_totals(spark, out).collect()) == [(12, 3, 2), (16, 1, 0), (17, 2, 0)]


def test_a_batch_run_again_and_a_fold_change_nothing(spark, log):
    path, out = in_parts(spark, log, 3), new_path(spark, "totals")
    counters.start_counting(stream_of(spark, log.schema, path), out, "6 hours").awaitTermination()
    expected = sorted(map(tuple, counters.request_totals(spark, out).collect()))
    sinks.remove(spark, f"{sinks.checkpoint_of(out)}/commits/2")  # as after a crash before the last commit
    counters.start_counting(stream_of(spark, log.schema, path), out, "6 hours").awaitTermination()
    assert sorted(map(tuple, counters.request_totals(spark, out).collect())) == expected
    for upto in (0, 1):
        counters.fold(spark, out, upto)
        assert sorted(map(tuple, counters.request_totals(spark, out).collect())) == expected
    log.where("event_id = 1").withColumn("ts", F.lit(datetime(1999, 1, 1))).coalesce(1).write.mode("append").parquet(path)
    counters.start_counting(stream_of(spark, log.schema, path), out, "6 hours").awaitTermination()
    assert counters.totals(spark, out, ()).select("requests").first()[0] == log.count() + 1
    assert counters.request_totals(spark, out).where("window_start < '2000-01-01'").select("late").first()[0] == 1


def test_requests_without_an_id_all_count(spark, log):
    path, out = new_path(spark, "in"), new_path(spark, "totals")
    log.limit(50).withColumn("event_id", F.lit(None).cast("long")).coalesce(1).write.parquet(path)
    counters.start_counting(counters.once(spark.readStream.schema(log.schema).parquet(path), "event_id"), out).awaitTermination()
    assert counters.totals(spark, out, ()).select("requests").first()[0] == 50


def test_each_run_has_its_own_drift(spark):
    """The run changes between two micro-batches, and the second one is run again."""
    rows = at_rest(star.dated_addr(spark, SF_DIR), "rows")
    first, second = (rows.where(F.col("address") % 2 == k).drop("address") for k in (0, 1))
    references = {"a": rows, "b": rows.where("income > 50000")}
    path, runs, out = (new_path(spark, n) for n in ("in", "runs", "drift"))
    held = live_drift.current_profile(spark, runs, "r")
    tables.log_run(spark, runs, "none", "r", datetime(2023, 1, 1), "", "", "")
    with pytest.raises(RuntimeError, match="no profile"):
        held()

    def start(**how):
        return live_drift.start_drift(spark.readStream.schema(first.schema).parquet(path), held, out, width="90 days", **how)

    for day, (run, part) in enumerate((("a", first), ("b", second)), 1):
        profile_path = new_path(spark, "profile")
        tables.save_profile(profile(references[run]), profile_path)
        tables.log_run(spark, runs, run, "r", datetime(2024, 1, day), "", "", "", profile_path)
        part.coalesce(1).write.mode("append").parquet(path)
        start().awaitTermination()
        assert held() is held() and held().run_id == run
    sinks.remove(spark, f"{sinks.checkpoint_of(out)}/commits/1")
    start().awaitTermination()
    got = {(r.run_id, r.window_start, r.feature): r for r in live_drift.drift_now(spark, out).collect()}
    assert {k[0] for k in got} == {"a", "b"}
    windows = sorted({k[1:2] + (r.window_end,) for k, r in got.items()})
    for begin, end in windows[:: max(1, len(windows) // 3)]:
        for run, part in (("a", first), ("b", second)):
            here = part.where((F.col("timestamp") >= F.lit(begin)) & (F.col("timestamp") < F.lit(end)))
            for row in drift(profile(references[run]), here).collect():
                if row.reason is None:
                    assert got[run, begin, row.feature].psi == pytest.approx(row.psi, abs=1e-9)
                    assert got[run, begin, row.feature]["mean"] == pytest.approx(row["mean"])


def test_counts_of_many_batches_merge(spark):
    rows = spark.createDataFrame([(i % 3, float(i * i)) for i in range(200)], "part int, value double")
    parts = rows.groupBy("part").agg(F.count("*").alias("n"), F.mean("value").alias("mean"), F.var_pop("value").alias("var")).withColumn("g", F.lit(1))
    n, mean, var = live_drift.merged(parts, ["g"]).select("n", "mean", "var").first()
    assert (n, mean, var) == pytest.approx(rows.agg(F.count("*"), F.mean("value"), F.var_pop("value")).first())


def test_late_rows_are_written_while_the_stream_runs_and_after_a_restart(spark):
    base = datetime(2024, 1, 1, 12)
    late = [(i, base + timedelta(minutes=m), 1, 0, "clean", 0.1) for i, m in enumerate((0, 300, 301, 2, 3, 600, 601, 4))]
    df = spark.createDataFrame(late, PREDICTION_LOG)
    path, out = new_path(spark, "in"), new_path(spark, "windows")
    for part in (range(4), range(4, 8)):
        for i in part:
            df.where(F.col("event_id") == i).coalesce(1).write.mode("append").parquet(path)
        listener = sinks.LateRows(spark, [out])
        spark.streams.addListener(listener)
        stream = monitor.windowed_requests(stream_of(spark, df.schema, path), "1 hour", "10 minutes")
        sinks.start_versions(stream, out, name=out).awaitTermination()
        listener.finish(1)
    counted = sinks.latest(spark, out, stream.schema, WINDOW).agg(F.sum("requests")).first()[0]
    dropped = spark.read.parquet(sinks.late_path(out))
    assert counted + dropped.agg(F.sum("dropped")).first()[0] == 8 and dropped.select("batch").distinct().count() >= 2
