"""Sinks that stay right when a micro-batch is run again."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from riskloom.session import at_rest, remove


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def checkpoint_of(path: str) -> str:
    """Where the progress of the stream that writes to ``path`` is kept: a restarted one goes on from there."""
    return f"{path.rstrip('/')}-checkpoint"


LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
#: What a query takes from the session when it starts. Keyed state with timers needs the disk-based state store.
OF_QUERY = {
    LOCAL_SESSIONS: "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str, checkpoint: str,
    once: bool = True, every: str = "1 minute", name: str | None = None,
) -> StreamingQuery:
    """Start ``handle`` on each micro-batch; ``once`` stops when the data at hand are done.

    Sessions are merged inside each task before the shuffle and state is kept on disk, whatever the session says: a
    query takes a copy of the settings when it starts.
    """
    conf = stream.sparkSession.conf
    before = {setting: conf.get(setting, None) for setting in OF_QUERY}
    for setting, value in OF_QUERY.items():
        conf.set(setting, value)
    try:
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
        writer = writer.queryName(name) if name else writer
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
    finally:
        for setting, value in before.items():
            conf.unset(setting) if value is None else conf.set(setting, value)


def late_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """batch and dropped: rows that came behind the watermark, for the micro-batches the query remembers.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` of them.
    """
    rows = [(p.batchId, sum(o.numRowsDroppedByWatermark for o in p.stateOperators)) for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch long, dropped long").where("dropped > 0")


class LateRows(StreamingQueryListener):
    """Writes the rows that each micro-batch left behind the watermark to ``<path>-late``, while its stream runs.

    Streams are known by their name, which is the path they write to. A folder per micro-batch is overwritten when that
    is run again. ``counters`` counts late rows with the batch itself; this is for streams whose state drops them.
    """

    def __init__(self, spark: SparkSession, paths: Sequence[str]):
        self.spark, self.paths, self.ended = spark, set(paths), threading.Semaphore(0)
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        if event.name in self.paths:
            self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        if progress.name in self.paths and dropped:
            rows = self.spark.createDataFrame([(dropped,)], "dropped long")
            rows.coalesce(1).write.mode("overwrite").parquet(batch_path(late_path(progress.name), progress.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.names.pop(str(event.runId), None):
            self.ended.release()

    def finish(self, queries: int, seconds: float = 60) -> None:
        """Wait until all that was reported of so many ended streams is written, and stop listening."""
        for _ in range(queries):
            self.ended.acquire(timeout=seconds)
        self.spark.streams.removeListener(self)


def late_path(path: str) -> str:
    return f"{path.rstrip('/')}-late"


def start_versions(stream: DataFrame, path: str, **how) -> StreamingQuery:
    """Write changed groups of a windowed aggregate, one folder per micro-batch.

    Update mode lets the watermark drop old state, unlike complete mode, and shows windows
    before they close, unlike append mode. A batch run again overwrites its own folder.
    """
    return start(stream, lambda df, i: df.write.mode("overwrite").parquet(batch_path(path, i)), "update", **{"checkpoint": checkpoint_of(path), **how})


def start_appends(stream: DataFrame, path: str, **how) -> StreamingQuery:
    """The same folders for streams whose rows are final when they come out."""
    return start(stream, lambda df, i: df.write.mode("overwrite").parquet(batch_path(path, i)), "append", **{"checkpoint": checkpoint_of(path), **how})


def latest(spark: SparkSession, path: str, schema, keys: Sequence[str]) -> DataFrame:
    """The newest version of every group written by ``start_versions``."""
    values = [c for c in schema.names if c not in keys]
    written = spark.read.schema(schema).parquet(path)
    newest = F.max_by(F.struct(*values), F.col("batch")).alias("newest")
    return written.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def compact(spark: SparkSession, path: str, schema, keys: Sequence[str], upto: int) -> None:
    """Fold the micro-batches up to ``upto``, which are done and not run again, into that one.

    A reader sees the same newest versions before, during and after: the folded folder is written first.
    """
    batch = F.col("batch")
    fields = [*schema.fields, StructField("batch", LongType())]
    written = spark.read.schema(StructType(fields)).parquet(path)
    old = sorted(r["batch"] for r in written.where(batch <= upto).select("batch").distinct().collect())
    values = [c for c in schema.names if c not in keys]
    newest = written.where(batch <= upto).groupBy(*keys).agg(F.max_by(F.struct(*values), batch).alias("newest"))
    at_rest(newest.select(*keys, "newest.*"), "compacted").select(*schema.names).write.mode("overwrite").parquet(batch_path(path, upto))
    for number in old:
        if number != upto:
            remove(spark, batch_path(path, number))
