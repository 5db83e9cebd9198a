import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("riskloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_rows(spark):
    """Five clean and three positive rows."""
    from riskloom.schemas import RAW

    rows = [
        (f"a{i}", 2010 + i % 3, 10 * i, 1, 0.5 * i, i, 0, i + 1, 100.0 * i, "white" if i < 5 else f"family{i}")
        for i in range(8)
    ]
    return spark.createDataFrame(rows, RAW)
