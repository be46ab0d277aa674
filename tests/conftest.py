import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fieldloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def animals(spark):
    rows = [
        (1, [(0, "mouse"), (1, "black")]),
        (2, [(0, "cat"), (1, "tabby"), (2, "mouse")]),
        (3, [(0, "bear"), (1, "black"), (2, "salmon")]),
    ]
    return spark.createDataFrame(rows, "id long, feature array<struct<_1: short, _2: string>>")
