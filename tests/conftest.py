import os
import tempfile

import pytest
from pyspark.sql import SparkSession

from tracklens.session import SETTINGS


def make_session(cores: str = "8") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tracklens-tests")
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tracklens-"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    return make_session()
