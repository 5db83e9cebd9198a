"""The order and event tables seen as address rows, prediction logs and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.schemas import NEGATIVE_NAME, POSITIVE_NAME, RAW

ROW_ID = ["address"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw-shaped row per order, with zeros for one without lines; ``address`` is the order key.

    Lines are summed per order before the join. Suppliers and parts are gathered as sets, which are first formed where
    the lines are read: an order's lines are not shuffled one by one, and of one holding very many only its distinct
    suppliers and parts come together. (Two distinct counts would shuffle every line three times over.)
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_linenumber").cast("long").alias("length"),
            F.round(F.sum("l_discount"), 6).alias("weight"),
            F.count("*").alias("count"),
            F.size(F.collect_set("l_suppkey")).cast("long").alias("suppliers"),
            F.size(F.collect_set("l_partkey")).cast("long").alias("neighbors"),
        )
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("address"),
        F.year("o_orderdate").alias("year"),
        F.dayofyear("o_orderdate").alias("day"),
        F.col("o_totalprice").alias("income"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderpriority"))
        .otherwise("white").alias("label"),
    )
    found = orders.join(lines, F.col("address") == F.col("l_orderkey"), "left")
    found = found.fillna(0, ["length", "weight", "count", "suppliers", "neighbors"])
    return found.select(
        "address", "year", "day", "length", "weight", "count",
        (F.col("count") - F.col("suppliers")).alias("looped"), "neighbors", "income", "label",
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``addr`` under the raw schema, with a text address."""
    rows = addr(spark, sf_dir)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW])


def addr_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``addr`` with nulls, negatives, a zero divisor and absent labels on some rows."""
    every = lambda n: F.col("address") % n == 0
    return addr(spark, sf_dir).select(
        "address",
        F.when(~every(97), F.col("year")).alias("year"),
        F.when(~every(89), F.col("day")).alias("day"),
        "length", "weight", "count",
        F.when(every(83), -F.col("looped") - 1).otherwise(F.col("looped")).alias("looped"),
        F.when(every(101), F.lit(-1).cast("long")).otherwise(F.col("neighbors")).alias("neighbors"),
        F.when(every(53), -F.col("income")).when(~every(59), F.col("income")).alias("income"),
        F.when(~every(103), F.col("label")).alias("label"),
    )


def addr_separable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``addr`` with a label that one feature decides, so that a fitted forest has a known answer."""
    label = F.when(F.col("count") >= 5, "many-lines").otherwise("white")
    return addr(spark, sf_dir).withColumn("label", label)


def addr_learnable(spark: SparkSession, sf_dir: str, noise_percent: int = 5) -> DataFrame:
    """``addr`` with a label that three features decide together, and that is wrong on some rows: it has to be learned."""
    rows = addr(spark, sf_dir)
    votes = sum((c.cast("int") for c in (F.col("income") > 200_000, F.col("neighbors") >= 5, F.col("weight") > 0.2)), F.lit(0))
    wrong = F.pmod(F.xxhash64("address"), F.lit(100)) < noise_percent
    return rows.withColumn("label", F.when((votes >= 2) != wrong, "two-signs").otherwise("white"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a score that is tied on many rows."""
    positive = (F.col("label") != "white").cast("int")
    return addr(spark, sf_dir).select(
        F.col("address").alias("id"),
        positive.alias("y"),
        ((F.col("address") * 7919 % 1000 + positive * 300) / F.lit(1300.0)).alias("score"),
    )


def prediction_log(events: DataFrame) -> DataFrame:
    """Event rows, batch or stream, as logged scoring requests."""
    kind = F.col("event_type")
    return events.select(
        "event_id",
        "ts",
        (F.col("user_id") % 4).alias("source"),
        (kind == "error").cast("int").alias("is_error"),
        F.when(kind == "purchase", POSITIVE_NAME).when(kind != "error", NEGATIVE_NAME).alias("prediction"),
        (F.col("value") / 100).alias("latency_seconds"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prediction_log(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream; watermarks need a zoned timestamp."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return prediction_log(events).withColumn("ts", F.col("ts").cast("timestamp"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as training runs, a few of them unfinished."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("run_name"),
        F.when(F.col("o_orderkey") % 2300 != 7, F.col("o_orderdate")).alias("end_time"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON request per address row, some broken, incomplete, or with extra fields."""
    every = lambda n: F.col("address") % n == 0
    fields = [
        F.concat(F.lit(f'"{c}":'), F.col(c).cast("string"))
        for c in ("year", "day", "length", "weight", "count", "looped", "neighbors")
    ]
    income = F.when(every(7), None).when(every(11), '"income":null').otherwise(
        F.concat(F.lit('"income":'), F.col("income").cast("string"))
    )
    extra = F.when(every(5), '"memo":"m-7"')
    body = F.concat(F.lit("{"), F.concat_ws(",", *fields, income, extra), F.lit("}"))
    return addr(spark, sf_dir).select("address", F.when(every(31), "<none>").otherwise(body).alias("body"))


def live_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address rows as live records with an event time."""
    return dated_addr(spark, sf_dir).drop("address")


def dated_addr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address and live record."""
    start = F.make_timestamp_ntz(F.col("year"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return addr(spark, sf_dir).select(
        "address", (start + F.make_dt_interval(F.col("day") - 1)).cast("timestamp").alias("timestamp"),
        "income", "neighbors", "weight",
    )
