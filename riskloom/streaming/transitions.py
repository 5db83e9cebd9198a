"""Alerts that are raised while a stream runs: each opening and each end of a condition comes out once.

Requests are first reduced to windows per key, so what follows sees a few rows per key and micro-batch, whatever share
of the requests one key has. Per key a small state is kept, with a timer in event time: a condition that nothing
further reports on still opens or ends once the watermark has passed the moment that decides it. The state lies in the
stream's checkpoint, so a restarted stream neither loses nor repeats a transition.

Times inside the state are microseconds; instants in the result are timestamps. Rows with a null key are a key of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

from riskloom.operators.alerts import error_counts, sample_windows
from riskloom.schemas import ERROR_RATIO
from riskloom.streaming.monitor import LATENESS

OPEN, CLOSED = "open", "closed"


def microseconds(spark: SparkSession, span: str) -> int:
    """The length of an interval of fixed length, such as ``5 minutes``."""
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {span})").first()[0]


class Episode:
    """Breaching windows in a row of one key."""

    def __init__(self, values: tuple | None):
        self.started, self.ended, self.windows, self.requests, self.errors, self.opened = values or (-1, -1, 0, 0, 0, False)

    @property
    def runs(self) -> bool:
        return self.started >= 0

    def values(self) -> tuple | None:
        return None if not self.runs else self._all()

    def _all(self) -> tuple:
        return self.started, self.ended, self.windows, self.requests, self.errors, self.opened

    def row(self, transition: str) -> tuple:
        return transition, self.started, self.ended, self.windows, self.requests, self.errors

    def end(self) -> list[tuple]:
        rows = [self.row(CLOSED)] if self.opened else []
        self.__init__(None)
        return rows

    def take(self, start: int, end: int, requests: int, errors: int, ratio: float, hold: int) -> list[tuple]:
        """The transitions that the next window of this key makes."""
        breach = errors / requests > ratio
        rows = self.end() if self.runs and not (breach and start == self.ended) else []
        if breach:
            self.started = self.started if self.runs else start
            self.ended = end
            self.windows, self.requests, self.errors = self.windows + 1, self.requests + requests, self.errors + errors
            if not self.opened and self.ended - self.started >= hold:
                self.opened = True
                rows.append(self.row(OPEN))
        return rows


class Stretch:
    """The time since the last healthy sample of one key, or since its first sample."""

    def __init__(self, values: tuple | None):
        self.since, self.opened = values or (None, False)

    def values(self) -> tuple:
        return self.since, self.opened

    def open(self, hold: int) -> list[tuple]:
        if self.opened:
            return []
        self.opened = True
        return [(OPEN, self.since, self.since + hold)]

    def take(self, first: int, up_from: int | None, up_to: int | None, hold: int) -> list[tuple]:
        """The transitions that the next window of samples of this key makes."""
        if self.since is None:
            self.since = first
        if up_from is None:
            return []
        rows = [*self.open(hold), (CLOSED, self.since, up_from)] if up_from - self.since >= hold else []
        self.since, self.opened = up_to, False
        return rows

    def decided_at(self, hold: int) -> int:
        """When the window that holds the instant ``hold`` after ``since`` is over: then no healthy sample can come before."""
        return ((self.since + hold) // hold + 1) * hold


def _keyed(windows: DataFrame, by: Sequence[str], *columns: Column) -> DataFrame:
    """One row per key and window, with the window's last instant, which carries the watermark."""
    return windows.select(*by, F.unix_micros("window.start").alias("start"), F.unix_micros("window.end").alias("end"), *columns, F.window_time("window").alias("at"))


class Watch(StatefulProcessor):
    """Keeps one value per key and a timer for the moment that decides what no row will tell."""

    STATE: str
    COLUMNS: tuple[str, ...]
    make: type
    names: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        yield from self._go_on(key, sorted(tuple(r[c] for c in self.COLUMNS) for r in rows), timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        yield from self._go_on(key, [], timerValues)

    def _go_on(self, key: tuple, windows: list[tuple], timers: TimerValues) -> Iterator[Row]:
        held = self.make(tuple(self.state.get()) if self.state.exists() else None)
        out = [row for window in windows for row in self.take(held, window)]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        until = self.waits_until(held)
        if until is not None and timers.getCurrentWatermarkInMs() * 1000 >= until:
            out += self.decide(held)
            until = None
        if until is not None:
            self.handle.registerTimer(-(-until // 1000))
        values = held.values()
        if values is None:
            self.state.clear()
        else:
            self.state.update(values)
        for row in out:
            yield Row(**dict(zip(self.names, (*key, *row))))

    def close(self) -> None:
        pass


class WatchErrors(Watch):
    STATE = "started long, ended long, windows long, requests long, errors long, opened boolean"
    COLUMNS = ("start", "end", "requests", "errors")
    make = Episode

    def __init__(self, width: int, ratio: float, hold: int):
        self.width, self.ratio, self.hold = width, ratio, hold

    def take(self, episode: Episode, window: tuple) -> list[tuple]:
        return episode.take(*window, self.ratio, self.hold)

    def waits_until(self, episode: Episode) -> int | None:
        return episode.ended + self.width if episode.runs else None

    def decide(self, episode: Episode) -> list[tuple]:
        return episode.end()


class WatchHealth(Watch):
    STATE = "since long, opened boolean"
    COLUMNS = ("start", "first_ts", "up_from", "up_to")
    make = Stretch

    def __init__(self, hold: int):
        self.hold = hold

    def take(self, stretch: Stretch, window: tuple) -> list[tuple]:
        _, first, up_from, up_to = window
        return stretch.take(first, *(None if up < 0 else up for up in (up_from, up_to)), self.hold)

    def waits_until(self, stretch: Stretch) -> int | None:
        return None if stretch.opened else stretch.decided_at(self.hold)

    def decide(self, stretch: Stretch) -> list[tuple]:
        return stretch.open(self.hold)


def _watched(rows: DataFrame, by: Sequence[str], watch: Watch, fields: str) -> DataFrame:
    schema = rows.select(*by).schema
    for field in StructType.fromDDL(fields).fields:
        schema = schema.add(field)
    watch.names = schema.names
    return rows.groupBy(*by).transformWithState(watch, schema, "append", "eventTime")


def error_transitions(
    log: DataFrame, width: str = "1 minute", ratio: float = ERROR_RATIO, hold: str = "5 minutes",
    by: Sequence[str] = ("source",), lateness: str = LATENESS,
) -> DataFrame:
    """Openings and ends of episodes of a high error share: key, transition, started, moment, windows, requests, errors.

    An episode opens with the window that makes it last ``hold``, and ends with the first window of its key that
    follows and is below ``ratio``, or is not there. Numbers are those up to ``moment``.
    """
    by, spark = list(by), log.sparkSession
    rows = _keyed(error_counts(log.withWatermark("ts", lateness), width, by), by, F.col("requests"), F.col("errors"))
    watch = WatchErrors(microseconds(spark, width), ratio, microseconds(spark, hold))
    found = _watched(rows, by, watch, "transition string, started long, moment long, windows long, requests long, errors long")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("started", "moment")})


def down_transitions(
    samples: DataFrame, hold: str = "1 minute", by: str = "source", healthy: str = "is_error = 0", lateness: str = LATENESS,
) -> DataFrame:
    """Openings and ends of stretches without a healthy sample: key, transition, down_from, moment.

    A stretch begins with a healthy sample, or the key's first sample; it opens ``hold`` after that and ends with
    the next healthy sample.
    """
    micros = [F.coalesce(F.unix_micros(c), F.lit(-1)).alias(c) for c in ("first_ts", "up_from", "up_to")]
    rows = _keyed(sample_windows(samples.withWatermark("ts", lateness), hold, by, healthy), [by], *micros)
    found = _watched(rows, [by], WatchHealth(microseconds(samples.sparkSession, hold)), "transition string, down_from long, moment long")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("down_from", "moment")})


def newest_states(transitions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per episode or stretch: its end, or its opening while it has not ended. ``keys`` name it."""
    values = [c for c in transitions.columns if c not in (*keys, "transition", "batch")]
    last = F.max_by(F.struct("transition", *values), F.when(F.col("transition") == CLOSED, 1).otherwise(0)).alias("last")
    return transitions.groupBy(*keys).agg(last).select(*keys, F.col("last.transition").alias("state"), *[f"last.{c}" for c in values])
