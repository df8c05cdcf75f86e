import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marinelake import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lines(spark):
    """Lines as a DataFrame with ``source_file, line_ord, ingest_ts, value``."""

    def make(values, source="f", start=0):
        rows = [(source, start + i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "source_file STRING, line_ord BIGINT, value STRING")
        return df.selectExpr("*", "timestamp'2020-01-01 00:00:00' AS ingest_ts")

    return make
