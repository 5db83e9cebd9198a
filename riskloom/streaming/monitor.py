"""Windowed request metrics, alerts and drift over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.alerts import down_sessions, down_stretches, error_counts, error_states, error_windows, sample_windows, sustained
from riskloom.operators.drift import bin_live, count_bins, score_bins
from riskloom.operators.metrics import latency_aggregates, latency_rows, request_aggregates
from riskloom.schemas import ERROR_RATIO, MONITORED_FEATURES
from riskloom.session import new_path
from riskloom.streaming.sinks import late_rows, latest, start_appends, start_versions

# How late a row may be. Later ones are left out of windows and alerts, and counted in a table beside the
# results (``<path>-late``).
LATENESS = "10 minutes"


def _flat_window(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others)


def windowed_requests(log: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    """Requests, errors and labels per window; partial counts leave each task before the shuffle."""
    counted = log.withWatermark("ts", lateness).groupBy(F.window("ts", width).alias("window")).agg(*request_aggregates())
    return _flat_window(counted)


def windowed_latency(log: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    """The cumulative latency counts per window, one wide row each; ``latency_rows`` unfolds them."""
    counted = log.withWatermark("ts", lateness).groupBy(F.window("ts", width).alias("window")).agg(*latency_aggregates())
    return _flat_window(counted)


def windowed_bins(
    live: DataFrame, profile: DataFrame, features: Sequence[str] = tuple(MONITORED_FEATURES),
    width: str = "1 hour", lateness: str = LATENESS,
) -> DataFrame:
    """Bin counts of live rows per window and feature, against a static profile."""
    watermarked = live.withWatermark("timestamp", lateness)
    binned = bin_live(watermarked, profile, features, keep=["timestamp"])
    return _flat_window(count_bins(binned, [F.window("timestamp", width).alias("window")]))


def error_alert_stream(
    log: DataFrame, width: str = "1 minute", ratio: float = ERROR_RATIO, hold: str = "5 minutes",
    by: Sequence[str] = ("source",), lateness: str = LATENESS,
) -> DataFrame:
    """Episodes of a high error share, out once the watermark has passed them (append mode)."""
    return sustained(error_windows(log.withWatermark("ts", lateness), width, ratio, by), width, hold, by)


def down_alert_stream(
    samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0",
    lateness: str = LATENESS,
) -> DataFrame:
    """Sources that have been quiet for ``hold`` (append mode)."""
    return down_sessions(samples.withWatermark("ts", lateness), hold, by, healthy)


def collect_windows(stream: DataFrame, keys: Sequence[str], name: str, path: str | None = None) -> DataFrame:
    """Run a windowed aggregate over the data at hand and read its newest versions."""
    spark = stream.sparkSession
    path = path or new_path(spark, name)
    query = start_versions(stream, path)
    query.awaitTermination()
    late_rows(spark, query).write.mode("append").parquet(f"{path}-late")
    return latest(spark, path, stream.schema, keys)


def collect_settled(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream over the data at hand and read what the watermark has passed."""
    spark = stream.sparkSession
    path = new_path(spark, name)
    query = start_appends(stream, path)
    query.awaitTermination()
    late_rows(spark, query).write.mode("append").parquet(f"{path}-late")
    return spark.read.schema(stream.schema).parquet(path).drop("batch")


def request_windows(log: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    return collect_windows(windowed_requests(log, width, lateness), ["window_start", "window_end"], "request-windows")


def latency_windows(log: DataFrame, width: str = "1 minute", lateness: str = LATENESS) -> DataFrame:
    keys = ["window_start", "window_end"]
    return latency_rows(collect_windows(windowed_latency(log, width, lateness), keys, "latency-windows"), keys)


def _whole_window(df: DataFrame) -> DataFrame:
    others = [c for c in df.columns if c not in ("window_start", "window_end")]
    return df.select(*others, F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("window"))


def windowed_errors(log: DataFrame, width: str = "1 minute", by: Sequence[str] = ("source",), lateness: str = LATENESS) -> DataFrame:
    return _flat_window(error_counts(log.withWatermark("ts", lateness), width, by))


def windowed_samples(
    samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0", lateness: str = LATENESS,
) -> DataFrame:
    return _flat_window(sample_windows(samples.withWatermark("ts", lateness), hold, by, healthy))


def error_alert_states(
    log: DataFrame, width: str = "1 minute", ratio: float = ERROR_RATIO, hold: str = "5 minutes",
    by: Sequence[str] = ("source",), lateness: str = LATENESS,
) -> DataFrame:
    """All episodes so far, open ones too: the stream keeps counts per window, the newest give the episodes."""
    counts = windowed_errors(log, width, by, lateness)
    found = collect_windows(counts, [*by, "window_start", "window_end"], "error-counts")
    return error_states(_whole_window(found), width, ratio, hold, by)


def down_alert_states(
    samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0", lateness: str = LATENESS,
) -> DataFrame:
    """All stretches so far without a healthy sample, open ones and sources never healthy too."""
    windows = windowed_samples(samples, hold, by, healthy, lateness)
    return down_stretches(_whole_window(collect_windows(windows, [by, "window_start", "window_end"], "sample-windows")), hold, by)


def drift_windows(
    live: DataFrame, profile: DataFrame, features: Sequence[str] = tuple(MONITORED_FEATURES),
    width: str = "1 hour", lateness: str = LATENESS,
) -> DataFrame:
    """Drift per window: the stream keeps bin counts, the index is worked out from the newest of them."""
    keys = ["window_start", "window_end", "feature", "bin"]
    counts = collect_windows(windowed_bins(live, profile, features, width, lateness), keys, "drift-windows")
    return score_bins(counts, profile, features, ["window_start", "window_end"])
