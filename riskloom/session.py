"""Session settings, the shared working folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table is broadcast only after it was counted to hold at most this many rows.
# The tables concerned have a handful of fixed-width columns, so this is a few MB.
BROADCAST_ROWS = 200_000


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; the master comes from spark-submit by default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def beside(spark: SparkSession) -> SparkSession:
    """A session over the same context with the same settings.

    A session that has observed metrics cannot be sent along with a fitted model's functions any more, so what is
    observed runs in a session of its own.
    """
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
        named = context.getCheckpointDir()
    return named


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def at_rest(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back.

    Operators that pass over their input several times take a table at rest: each
    pass then reads only the columns it needs, and a lost executor costs a re-read
    rather than the whole lineage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast when the counted size allows; otherwise leave the join to Spark.

    Beyond the bound the join is a shuffle join, where adaptive execution splits hot keys.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
