import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
        .config("spark.sql.maxMetadataStringLength", "2000").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from lakeops.session import ship_package

    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from lakeops.fixtures import Lake

    return Lake(spark, SF)
