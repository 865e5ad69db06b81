from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tidemark.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(base / "shared"),
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__sql__streaming__noDataMicroBatches__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def readings(spark):
    """Six readings of three stations on two days."""
    rows = [
        ("Aldermoor", "GB", 4.25, 91, 996, 7.5, "Rain", "drizzle", 1667628000, 53.5, -1.25),
        ("Aldermoor", "GB", 7.75, 84, 999, 5.25, "Mist", "thin mist", 1667671200, 53.5, -1.25),
        ("Aldermoor", "GB", 3.5, 88, 1003, 2.0, "Rain", "heavy rain", 1667714400, 53.5, -1.25),
        ("Brinkum", "DE", -1.5, 97, 1021, 0.75, "Snow", "wet snow", 1667638800, 53.25, 7.5),
        ("Corvalho", "PT", 19.25, 40, 1017, 4.5, "Clear", "sunny", 1667746800, 40.75, -8.5),
        ("Corvalho", "PT", 18.75, 44, 1016, 6.25, "Clear", "sunny", 1667752200, 40.75, -8.5),
    ]
    return spark.createDataFrame(
        rows,
        "city string, country string, temperature double, humidity int, pressure int,"
        "wind_speed double, weather_condition string, weather_description string,"
        "recorded_dt long, latitude double, longitude double",
    )
