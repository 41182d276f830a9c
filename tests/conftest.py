import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("steprisk-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tx(spark):
    from steprisk.sources.events import read_events_as_transactions

    return read_events_as_transactions(spark, SMALL).persist()


@pytest.fixture(scope="session")
def features(spark, tx, tmp_path_factory):
    from steprisk.operators.history import behavioral_features
    from steprisk.sources.features import write_features

    path = str(tmp_path_factory.mktemp("features") / "table")
    write_features(behavioral_features(tx), path)
    return spark.read.parquet(path)
