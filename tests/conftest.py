from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from demandgrid import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hourly_frame(spark):
    """(location → values) to a series frame, one row per hour from a start."""

    def build(values: dict[int, list], start: datetime = datetime(2024, 1, 1)):
        rows = [
            (start + timedelta(hours=i), loc, v) for loc, series in values.items() for i, v in enumerate(series)
        ]
        return spark.createDataFrame(rows, "pickup_hour timestamp_ntz, pickup_location_id bigint, rides bigint")

    return build


@pytest.fixture
def rides_frame(spark):
    def build(rows):
        return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, pickup_location_id bigint")

    return build
