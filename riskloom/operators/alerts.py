"""Alert conditions that must hold for a while before they fire."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schemas import ERROR_RATIO


def error_counts(log: DataFrame, width: str = "1 minute", by: Sequence[str] = ("source",)) -> DataFrame:
    """Requests and errors per key and window. Reduced before the shuffle."""
    return log.groupBy(*by, F.window("ts", width).alias("window")).agg(
        F.count("*").alias("requests"), F.count_if(F.col("is_error") == 1).alias("errors")
    )


def error_windows(log: DataFrame, width: str = "1 minute", ratio: float = ERROR_RATIO, by: Sequence[str] = ("source",)) -> DataFrame:
    """Windows whose share of failed requests is above ``ratio``."""
    return error_counts(log, width, by).where(F.col("errors") / F.col("requests") > ratio)


def sustained(breaches: DataFrame, width: str, hold: str, by: Sequence[str] = ("source",), at: Column | None = None) -> DataFrame:
    """Join breaching windows that follow each other into episodes lasting at least ``hold``.

    A window without rows ends an episode. The input has one row per key and window, so
    its size goes with the time covered, not with the traffic. Works on streams too
    (append mode), where ``breaches`` comes out of a watermarked aggregate. ``at`` is the last instant
    of a window, where that was read from a table and ``window_time`` is not to be had.
    """
    # window_time is the last instant of a window: neighbours are exactly one width apart,
    # and a gap reaching just past that joins them while leaving out the next but one.
    started = F.col("window.start")
    episodes = (
        breaches.withColumn("_start", started)
        .groupBy(*by, F.session_window(F.window_time("window") if at is None else at, f"{width} 1 millisecond").alias("episode"))
        .agg(
            F.min("_start").alias("started"),
            F.max("window.end").alias("ended"),
            F.count("*").alias("windows"),
            F.sum("requests").alias("requests"),
            F.sum("errors").alias("errors"),
        )
    )
    long_enough = F.col("ended") >= F.col("started") + F.expr(f"INTERVAL {hold}")
    return episodes.where(long_enough).drop("episode")


def error_rate_alert(
    log: DataFrame, width: str = "1 minute", ratio: float = ERROR_RATIO, hold: str = "5 minutes",
    by: Sequence[str] = ("source",),
) -> DataFrame:
    """Episodes in which the error share stayed above ``ratio`` for at least ``hold``."""
    return sustained(error_windows(log, width, ratio, by), width, hold, by)


def error_states(
    counts: DataFrame, width: str = "1 minute", ratio: float = ERROR_RATIO, hold: str = "5 minutes",
    by: Sequence[str] = ("source",),
) -> DataFrame:
    """The episodes with their state, from counts per key and window: open if the log ends in their last window."""
    end = F.lit(counts.agg(F.max("window.end").cast("string")).first()[0])
    last_instant = F.col("window.end") - F.expr("INTERVAL 1 MICROSECOND")
    episodes = sustained(counts.where(F.col("errors") / F.col("requests") > ratio), width, hold, by, last_instant)
    return episodes.withColumn("state", F.when(F.col("ended").cast("string") == end, "open").otherwise("closed"))


def sample_windows(samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0") -> DataFrame:
    """First and last sample, and first and last healthy one, per source and window of width ``hold``.

    Two samples in one such window are less than ``hold`` apart, so no others matter. The size goes with
    the time covered, whatever share of the rows one source has.
    """
    well = F.when(F.expr(healthy), F.col("ts"))
    return samples.groupBy(by, F.window("ts", hold).alias("window")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min(well).alias("up_from"), F.max(well).alias("up_to")
    )


def down_stretches(windows: DataFrame, hold: str = "1 minute", by: str = "source") -> DataFrame:
    """Stretches of at least ``hold`` without a healthy sample: source, down_from, down_until and state.

    A stretch lasts from a healthy sample to the next one; one before the first healthy sample begins with the
    source's first sample. One after the last, or of a source that never was healthy, is open: it lasts until the
    last sample of the whole log.
    """
    bounds = windows.groupBy(by).agg(F.min("first_ts").alias("first"), F.max("last_ts").alias("last"))
    # One row per source here.
    bounds = bounds.withColumn("log_end", F.max("last").over(Window.partitionBy(F.lit(0))))
    marks = (
        windows.where("up_from IS NOT NULL").select(by, F.col("up_from").alias("begin"), F.col("up_to").alias("end"), F.lit("closed").alias("state"), F.lit(1).alias("rank"))
        .union(bounds.select(by, "first", "first", F.lit("closed"), F.lit(0)))
        .union(bounds.select(by, "log_end", "log_end", F.lit("open"), F.lit(2)))
    )
    earlier = Window.partitionBy(by).orderBy("begin", "rank")
    stretch = marks.select(by, F.lag("end").over(earlier).alias("down_from"), F.col("begin").alias("down_until"), "state")
    return stretch.where(F.col("down_until") >= F.col("down_from") + F.expr(f"INTERVAL {hold}"))


def down_alert(samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0") -> DataFrame:
    """Stretches of at least ``hold`` without a healthy sample, per source, open ones included."""
    return down_stretches(sample_windows(samples, hold, by, healthy), hold, by)


def down_sessions(samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0") -> DataFrame:
    """The same condition on a stream: a session of healthy samples that went quiet for ``hold``.

    ``samples`` carries a watermark on ``ts``; a row comes out once that passes the quiet time. Start it with
    ``local_sessions`` (see ``streaming.sinks``), so that samples are merged before the shuffle.
    """
    return (
        samples.where(healthy)
        .groupBy(by, F.session_window("ts", hold).alias("up"))
        .agg(F.count("*").alias("samples"))
        .select(by, F.col("up.start").alias("up_from"), (F.col("up.end") - F.expr(f"INTERVAL {hold}")).alias("down_from"), "samples")
    )
