import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from packetloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests")
    session = configure(
        builder,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    ).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
