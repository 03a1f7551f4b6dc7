from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

from hostpulse.session import open_session


def open_test_session() -> SparkSession:
    spark = open_session(
        "hostpulse-tests",
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="hostpulse-tests-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = open_test_session()
    yield session
    session.stop()
