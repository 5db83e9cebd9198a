"""Alert transitions on streams, cut in many batches and restarted, against the batch operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators import alerts
from riskloom.session import at_rest, new_path
from riskloom.sources import star
from riskloom.streaming import sinks, transitions

SF_DIR = "/root/testdata/sf0.001"
START = datetime(2024, 5, 1)
LOG = "source long, ts timestamp, is_error int"


def run_in_parts(spark, parts, make):
    """One start of the stream per part, each reading the files that are new; all rows written."""
    path, out = new_path(spark, "in"), new_path(spark, "out")
    schema = parts[0].schema
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        stream = make(spark.readStream.schema(schema).parquet(path))
        sinks.start_appends(stream, out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@pytest.fixture(scope="module")
def log(spark):
    """The event log, and one row a year later that lets the watermark pass everything before."""
    rows = star.event_log(spark, SF_DIR).select("source", F.col("ts").cast("timestamp").alias("ts"), "is_error")
    return at_rest(rows, "log")


def flush(spark, log):
    last = log.agg(F.max("ts")).first()[0]
    return spark.createDataFrame([(-1, last + timedelta(days=365 * i), 0) for i in (1, 2)], LOG)


def parts_of(log, n):
    cuts = log.agg(F.percentile_approx("ts", [i / n for i in range(1, n)], 10000)).first()[0]
    edges = [None, *cuts, None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        yield log.where((F.lit(True) if lo is None else F.col("ts") > lo) & (F.lit(True) if hi is None else F.col("ts") <= hi))


def test_error_transitions_equal_batch_episodes_after_restarts(spark, log):
    got = run_in_parts(spark, [*parts_of(log, 3), flush(spark, log)], lambda s: transitions.error_transitions(s, "6 hours", 0.2, "12 hours"))
    batch = alerts.error_rate_alert(log, "6 hours", 0.2, "12 hours").select("source", "started", "ended", "windows", "requests", "errors")
    closed = got.where("transition = 'closed'").select("source", "started", "moment", "windows", "requests", "errors")
    assert sorted(map(tuple, closed.collect())) == sorted(map(tuple, batch.collect())) != []
    opened = got.where("transition = 'open'").select("source", "started", (F.col("moment") >= F.col("started") + F.expr("INTERVAL 12 HOURS")).alias("held"))
    assert sorted(map(tuple, opened.collect())) == sorted((r.source, r.started, True) for r in batch.collect())


def test_down_transitions_equal_batch_stretches_after_restarts(spark, log):
    got = run_in_parts(spark, [*parts_of(log, 3), flush(spark, log)], lambda s: transitions.down_transitions(s, "3 hours"))
    batch = alerts.down_stretches(alerts.sample_windows(log, "3 hours"), "3 hours").where("down_from < down_until").collect()
    of = lambda kind: sorted((r.source, r.down_from, r.moment) for r in got.where(F.col("transition") == kind).collect() if r.source >= 0)
    assert of("closed") == sorted((r.source, r.down_from, r.down_until) for r in batch if r.state == "closed") != []
    opened = {(r.source, r.down_from): r.down_from + timedelta(hours=3) for r in batch}
    ends = {(s, d): at for s, d, at in of("open")}
    assert len(ends) == len(of("open")) and {k: v for k, v in ends.items() if k in opened} == opened
    # A stretch that reaches past the log's end by less than the hold is open on the stream alone, which saw a later row.
    last = log.agg(F.max("ts")).first()[0]
    assert all(d + timedelta(hours=3) > last for (s, d) in ends if (s, d) not in opened)


def minutes(spark, pattern):
    rows = [(1, START + timedelta(minutes=i, seconds=k), int(c == "x")) for i, c in enumerate(pattern) if c != "." for k in range(3)]
    return spark.createDataFrame(rows, LOG)


def seen(rows, *columns):
    return [(r.transition, *(int((r[c] - START).total_seconds() // 60) for c in columns)) for r in sorted(rows.collect(), key=lambda r: (r.moment, r.transition == "closed"))]


def test_an_open_alert_is_raised_once_and_before_it_ends(spark):
    """Ten failing minutes in four files: open after five, and still open when the log ends."""
    whole = minutes(spark, "ox" + "x" * 9)
    parts = [whole.where(F.col("ts") < START + timedelta(minutes=b)).where(F.col("ts") >= START + timedelta(minutes=a)) for a, b in ((0, 4), (4, 7), (7, 8), (8, 11))]
    make = lambda s: transitions.error_transitions(s, lateness="0 seconds")
    got = run_in_parts(spark, parts, make)
    assert seen(got, "started", "moment") == [("open", 1, 6)]
    assert [tuple(r) for r in transitions.newest_states(got, ["source", "started"]).select("state", "windows", "errors").collect()] == [("open", 5, 15)]


@pytest.mark.parametrize("pattern, expected", [
    ("xxxxxo", [("open", 0, 5), ("closed", 0, 5)]),
    ("xxxx.xxxx", []),
    ("xxxxx.xxxxxx", [("open", 0, 5), ("closed", 0, 5), ("open", 6, 11), ("closed", 6, 12)]),
    ("oxxxxxxxo", [("open", 1, 6), ("closed", 1, 8)]),
])
def test_episodes_by_the_state_machine(pattern, expected):
    episode, out = transitions.Episode(None), []
    for i, c in enumerate(pattern):
        if c != ".":
            out += episode.take(i, i + 1, 3, 3 * (c == "x"), 0.05, 5)
    out += episode.end()
    assert [(t, s, a) for t, s, a, *_ in out] == expected


def test_stretches_by_the_state_machine():
    stretch, out = transitions.Stretch(None), []
    for first, up_from, up_to in [(3, None, None), (12, 14, 18), (25, 25, 29), (33, None, None), (41, 41, 41)]:
        out += stretch.take(first, up_from, up_to, 10)
    assert out == [("open", 3, 13), ("closed", 3, 14), ("open", 29, 39), ("closed", 29, 41)]
    assert stretch.decided_at(10) == 60 and stretch.open(10) == [("open", 41, 51)] and stretch.open(10) == []
