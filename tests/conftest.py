from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from dumpflow.session import prepare


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("dumpflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def lines_of(spark):
    """Frame of (value, file_name) rows from plain Python lines."""
    def make(values, file_name="enwiki-20240101-x.sql"):
        return spark.createDataFrame([(v, file_name) for v in values], "value string, file_name string")

    return make
