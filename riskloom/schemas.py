"""Row types and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Names, labels and settings that results depend on.
CLEAN_LABEL = "white"
TARGET = "is_ransomware"
POSITIVE_NAME = "ransomware"
NEGATIVE_NAME = "clean"
DECISION_THRESHOLD = 0.5
NUMERIC_COLUMNS = ["year", "day", "length", "weight", "count", "looped", "neighbors", "income"]
LOGGED_COLUMNS = ["income", "weight", "count", "looped"]
UNMODELLED_COLUMNS = ["year", "income", "length"]
MONITORED_FEATURES = ["income", "neighbors", "weight"]
FEATURE_COLUMNS = [
    "day", "weight", "count", "looped", "neighbors",
    "log_income", "log_weight", "log_count", "log_looped",
    "activity_index", "weight_to_count", "income_per_neighbor",
    "days_since_2009", "sin_day", "cos_day",
    "income_z", "income_z_by_year",
]
EPOCH_YEAR = 2009
DAYS_PER_YEAR = 365
SEED = 42
TEST_FRACTION = 0.2
NUM_FOLDS = 3
NUM_TREES = 20
MAX_DEPTH = 20
LIVE_DRAWS = 1000
LIVE_MISSING_RATE = 0.05
PSI_EPSILON = 1e-6
ERROR_RATIO = 0.05
RUN_NAME = "training_run"
# Default latency bounds of the public Prometheus client, in seconds.
LATENCY_BOUNDS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
]

RAW = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("length", T.LongType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("count", T.LongType()),
    T.StructField("looped", T.LongType()),
    T.StructField("neighbors", T.LongType()),
    T.StructField("income", T.DoubleType()),
    T.StructField("label", T.StringType()),
])

# One scoring request: the numeric raw columns. Senders may give fractions anywhere but in the year.
REQUEST = T.StructType([
    T.StructField(name, T.IntegerType() if name == "year" else T.DoubleType()) for name in NUMERIC_COLUMNS
])

# Fitted z-score state: one 'global' row and one row per year.
STATE = T.StructType([
    T.StructField("scope", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])

# Reference profile: one row per monitored feature.
PROFILE = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("missing_ratio", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("hist", T.ArrayType(T.LongType())),
    T.StructField("bin_edges", T.ArrayType(T.DoubleType())),
    T.StructField("num_bins", T.IntegerType()),
])

LIVE = T.StructType(
    [T.StructField("timestamp", T.TimestampType())]
    + [T.StructField(name, T.DoubleType()) for name in MONITORED_FEATURES]
)

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("state_path", T.StringType()),
    T.StructField("columns_path", T.StringType()),
    T.StructField("profile_path", T.StringType()),
])

PREDICTION_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("source", T.LongType()),
    T.StructField("is_error", T.IntegerType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("latency_seconds", T.DoubleType()),
])
