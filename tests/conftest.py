from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridemill.session import SESSION_SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("ridemill-tests")
    settings = {
        **SESSION_SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def routes(spark):
    return spark.createDataFrame([("R001",), ("R002",)], "route_id string")


@pytest.fixture(scope="session")
def vehicles(spark):
    rows = [("V0001", "Bus", 50), ("V0002", "Subway", 300)]
    return spark.createDataFrame(rows, "vehicle_id string, vehicle_type string, capacity int")
