import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablehaul.sources.files import clear_work  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablehaul-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_work(session)
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture()
def keyed(spark):
    """A one-column table of the given bigint keys over a few partitions."""

    def build(keys, parts=3):
        return spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(parts)

    return build
