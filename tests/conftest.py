import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A frame from rows and a DDL schema; dates and times are given as text."""

    def build(rows, schema):
        fields = [part.strip().split(" ") for part in schema.split(",")]
        text = ", ".join(f"{n} {'string' if t in ('date', 'timestamp_ntz') else t}" for n, t in fields)
        df = spark.createDataFrame(rows, text)
        return df.selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields])

    return build
