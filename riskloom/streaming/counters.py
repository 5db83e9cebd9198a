"""Request counters that lose no request, however late it comes, and count none twice.

A windowed aggregate under a watermark gives up a window's state once the watermark has passed it, and with it every
later row of that window. Here each micro-batch is reduced to its own counts per window, which go into a folder named
by the batch, and readers add the folders up. There is no state that could be given up: rows of a window long past
are one more addend, a correction. The batch's counts also say how many of its rows were late, that is of windows that
ended ``lateness`` or more before the newest row of all earlier batches. That mark is read back from the folders written
before, so a batch run again after a crash, or a stream started again, splits its rows the same way and overwrites its folder.

``once`` drops requests that are delivered again. Its state is bounded by arrival, not by event time, so late rows pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.metrics import latency_aggregates, latency_rows, request_aggregates
from riskloom.schemas import LATENCY_BOUNDS, NEGATIVE_NAME, POSITIVE_NAME
from riskloom.session import remove
from riskloom.sources.tables import exists
from riskloom.streaming.monitor import LATENESS
from riskloom.streaming.sinks import batch_path, checkpoint_of, start

#: How long after its first arrival a request is still known.
REDELIVERY = "1 hour"
COUNTED = ["requests", "errors", POSITIVE_NAME, NEGATIVE_NAME, "late", "observations"]
COUNTS = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    *[T.StructField(name, T.LongType()) for name in COUNTED],
    T.StructField("counts", T.ArrayType(T.LongType())),
    T.StructField("total_seconds", T.DoubleType()),
    T.StructField("newest", T.TimestampType()),
])
FOLDS = T.StructType([T.StructField("upto", T.LongType()), T.StructField("path", T.StringType())])


def once(rows: DataFrame, key: str, within: str = REDELIVERY) -> DataFrame:
    """Rows of a stream whose ``key`` did not arrive before, up to ``within`` ago; all rows without a key."""
    name = F.coalesce(F.concat(F.lit("key "), F.col(key).cast("string")), F.concat(F.lit("none "), F.uuid()))
    marked = rows.withColumns({"_arrived": F.current_timestamp(), "_delivery": name})
    return marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_delivery"]).drop("_arrived", "_delivery")


def batch_counts(log: DataFrame, width: str, lateness: str, mark: Column) -> DataFrame:
    """Counts per window of one micro-batch, late rows told apart; reduced inside each task first."""
    late = F.col("window_end") <= mark - F.expr(f"INTERVAL {lateness}")
    counted = log.groupBy(F.window("ts", width).alias("window")).agg(*request_aggregates(), *latency_aggregates(), F.max("ts").alias("newest"))
    flat = counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*")
    return flat.withColumn("late", F.when(late, F.col("requests")).otherwise(F.lit(0).cast("long"))).select(*COUNTS.names)


def start_counting(log: DataFrame, path: str, width: str = "1 minute", lateness: str = LATENESS, **how) -> StreamingQuery:
    """Write the counts of every micro-batch of the log to its folder under ``path``."""
    spark, held = log.sparkSession, {}

    def mark_before(batch_id: int) -> datetime | None:
        """The newest event of all batches before this one."""
        if held.get("batch") != batch_id - 1:
            held["mark"] = _read(spark, path).where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0] if batch_id else None
        return held["mark"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        mark = mark_before(batch_id)
        batch_counts(batch, width, lateness, F.lit(mark).cast("timestamp")).write.mode("overwrite").parquet(batch_path(path, batch_id))
        newest = spark.read.schema(COUNTS).parquet(batch_path(path, batch_id)).agg(F.max("newest")).first()[0]
        held.update(batch=batch_id, mark=max((t for t in (mark, newest) if t is not None), default=None))

    return start(log, handle, "append", **{"checkpoint": checkpoint_of(path), **how})


def _fold_log(path: str) -> str:
    return f"{path.rstrip('/')}-folds"


def _read(spark: SparkSession, path: str) -> DataFrame:
    """All counts with their batch: the newest fold, and the folders after it."""
    rows = spark.read.schema(T.StructType([*COUNTS.fields, T.StructField("batch", T.LongType())])).parquet(path)
    if not exists(spark, _fold_log(path)):
        return rows
    upto, folded = spark.read.schema(FOLDS).parquet(_fold_log(path)).agg(F.max(F.struct("upto", "path"))).first()[0]
    fold = spark.read.schema(COUNTS).parquet(folded).withColumn("batch", F.lit(upto).cast("long"))
    return rows.where(F.col("batch") > upto).unionByName(fold)


def _added(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    buckets = F.array(*[F.sum(F.get("counts", F.lit(i))) for i in range(len(LATENCY_BOUNDS) + 1)])
    return rows.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTED], buckets.alias("counts"), F.sum("total_seconds").alias("total_seconds"), F.max("newest").alias("newest"))


def totals(spark: SparkSession, path: str, by: Sequence[str] = ("window_start", "window_end")) -> DataFrame:
    """The counts of all micro-batches added up per window, or over all (``by=()``)."""
    return _added(_read(spark, path), by)


def request_totals(spark: SparkSession, path: str) -> DataFrame:
    """Requests, errors, labels and late rows per window."""
    return totals(spark, path).drop("counts", "observations", "total_seconds", "newest")


def latency_totals(spark: SparkSession, path: str) -> DataFrame:
    """Cumulative latency counts per window and bound."""
    return latency_rows(totals(spark, path), ["window_start", "window_end"])


def fold(spark: SparkSession, path: str, upto: int) -> None:
    """Add the folders of the micro-batches up to ``upto``, which are done and not run again, into one table.

    The fold is whole before the log names it, and only then the folders go; a reader sees either the one or the others.
    """
    folded = f"{_fold_log(path)}-{upto}"
    rows = _read(spark, path)
    _added(rows.where(F.col("batch") <= upto), ["window_start", "window_end"]).select(*COUNTS.names).write.mode("overwrite").parquet(folded)
    done = [r["batch"] for r in spark.read.schema("batch long").parquet(path).where(F.col("batch") <= upto).select("batch").distinct().collect()]
    spark.createDataFrame([(upto, folded)], FOLDS).write.mode("append").parquet(_fold_log(path))
    for number in done:
        remove(spark, batch_path(path, number))
