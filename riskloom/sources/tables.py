"""Tables at rest: raw rows, fitted state, profiles, models and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.zscore import NOT_FITTED
from riskloom.schemas import LIVE, PROFILE, RAW, RUN_LOG, STATE
from riskloom.session import at_rest
from riskloom.sources.json_array import read_json_array

# Names under which an exported index column appears.
INDEX_COLUMNS = ["_c0", "Unnamed: 0"]


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows from CSV with a header, columns found by name.

    Spark applies a given schema by position, which an index column in front would shift.
    So the names come from the header and the types from a cast; only the header is read ahead.
    Text that is no number becomes null.
    """
    text = spark.read.option("header", True).csv(path).drop(*INDEX_COLUMNS)
    absent = [f.name for f in RAW if f.name not in text.columns]
    if absent:
        raise ValueError(f"The CSV header lacks {absent}.")

    def typed(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.LongType)):
            # Whole numbers may be written as '3.0'.
            return F.coalesce(value.try_cast(field.dataType), value.try_cast("double").try_cast(field.dataType))
        return value.try_cast(field.dataType)

    return text.select(*[typed(f).alias(f.name) for f in RAW])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, on whatever file system it lies."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def read_live_json(spark: SparkSession, path: str, one_array: bool | str = False) -> DataFrame:
    """Live records; an error when there are none.

    Records are one JSON object a line. ``one_array`` reads files that are a single JSON array: one task
    a file, or many tasks each with ``one_array="ranges"``.
    """
    if one_array == "ranges":
        live = read_json_array(spark, path, LIVE)
    else:
        live = spark.read.schema(LIVE).option("multiLine", one_array).json(path)
    if live.isEmpty():
        raise RuntimeError(f"There are no live records in {path}.")
    return live


def write_live_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line, with missing values written as explicit nulls."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def newest_first(live: DataFrame) -> DataFrame:
    """For display; nothing computed from live rows depends on their order."""
    return live.orderBy(F.desc("timestamp"))


def save_state(state: DataFrame, path: str) -> None:
    """Write a fitted state, computed once; refuse one without global and yearly rows."""
    fitted = at_rest(state.select(*STATE.names), "fitted")
    scopes = {r["scope"] for r in fitted.select("scope").distinct().collect()}
    if scopes != {"global", "year"}:
        raise RuntimeError(NOT_FITTED)
    write_table(fitted, path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, STATE)


def save_profile(profile: DataFrame, path: str) -> None:
    write_table(profile.select(*PROFILE.names), path)


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, PROFILE)


def load_profile_json(spark: SparkSession, path: str) -> DataFrame:
    """A profile kept as one JSON object: feature name to its values."""
    entry = T.StructType(PROFILE.fields[1:])
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json("value", T.MapType(T.StringType(), entry))).alias("feature", "entry"))
        .select("feature", "entry.*")
    )


def save_profile_json(profile: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The profile as one JSON object; it has one entry per monitored feature."""
    names = PROFILE.names[1:]
    entries = F.map_from_entries(F.collect_list(F.struct("feature", F.struct(*names))))
    text = F.to_json(entries, {"ignoreNullFields": "false"})
    profile.agg(text.alias("value")).coalesce(1).write.mode(mode).text(path)


def save_columns(spark: SparkSession, columns: Sequence[str], path: str) -> None:
    """The ordered feature columns as a JSON array. The saved model holds them too."""
    listed = spark.range(1).select(F.to_json(F.array(*[F.lit(c) for c in columns])).alias("value"))
    listed.coalesce(1).write.mode("overwrite").text(path)


def load_columns(spark: SparkSession, path: str) -> list[str]:
    listed = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>").alias("columns"))
    return listed.first()["columns"]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def log_run(
    spark: SparkSession, path: str, run_id: str, run_name: str, end_time, model_path: str, state_path: str,
    columns_path: str, profile_path: str | None = None,
) -> None:
    """Append one row to the run log, after all that it names was written; none of it is ever overwritten."""
    row = (run_id, run_name, end_time, model_path, state_path, columns_path, profile_path)
    spark.createDataFrame([row], RUN_LOG).write.mode("append").parquet(path)


def load_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RUN_LOG)
