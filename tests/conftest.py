import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.timeType.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def stock(spark):
    """Parts in a warehouse: one name needs quotes in CSV."""
    rows = [{"sku": 7, "part": "rivet", "bins": 310}, {"sku": 9, "part": "nut, hex", "bins": 45}]
    return spark.createDataFrame(rows, "sku int, part string, bins int")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
