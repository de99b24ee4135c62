import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.default.parallelism": "4",
    }
    session = SparkSession.builder.master("local[4]").appName("tests").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """The value of an expression over named string values."""

    def value(expression, **columns):
        return spark.createDataFrame([tuple(columns.values()) or ("",)], ", ".join(f"{c} string" for c in columns) or "x string").select(expression.alias("v")).first().v

    return value
