import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from pyspark.sql import SparkSession  # noqa: E402

#: Started at once: test modules build columns while they are collected.
SESSION = (
    SparkSession.builder.master("local[4]").appName("tests")
    .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()
