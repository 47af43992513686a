from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandgrid.functions import numbers, times


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_half_even(spark):
    got = column(spark, [0.5, 1.5, 2.5, -0.5, None], "double", numbers.round_half_even)
    assert got == [0.0, 2.0, 2.0, 0.0, None]


def test_floor_at_keeps_null(spark):
    assert column(spark, [-1.0, 0.0, 3.0, None], "double", lambda c: numbers.floor_at(c, 0.0)) == [0.0, 0.0, 3.0, None]


def test_row_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1, None, 4), (None, None, None), (2, 4, 6)], "a int, b int, c int")
    got = [r.m for r in df.select(numbers.row_mean(F.col("a"), F.col("b"), F.col("c")).alias("m")).collect()]
    assert got == [2.5, None, 4.0]


def test_weekday_monday_is_zero(spark):
    got = column(spark, [datetime(2024, 1, 1), datetime(2024, 1, 7)], "timestamp_ntz", times.day_of_week)
    assert got == [0, 6]


def test_clock(spark):
    ten = datetime(2024, 5, 1, 10)
    inputs = [ten, ten + timedelta(seconds=1), ten + timedelta(minutes=59, seconds=59)]
    assert [times.clock_floor(t) for t in inputs] == [ten] * 3
    assert [times.clock_ceil(t).hour for t in inputs] == [10, 11, 11]
    assert [times.next_hour(t).hour for t in inputs] == [11, 11, 11]
    assert column(spark, inputs, "timestamp_ntz", times.floor_hour) == [ten] * 3
    assert [t.hour for t in column(spark, inputs, "timestamp_ntz", times.ceil_hour)] == [10, 11, 11]
    assert [t.hour for t in column(spark, inputs, "timestamp_ntz", times.next_hour_of)] == [11, 11, 11]


def test_new_york_wall_time_over_clock_changes(spark):
    utc = [datetime(2024, 3, 10, 6, 30), datetime(2024, 3, 10, 7, 30), datetime(2024, 11, 3, 5, 30), datetime(2024, 11, 3, 6, 30)]
    assert column(spark, utc, "timestamp_ntz", times.wall_time) == [
        datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30), datetime(2024, 11, 3, 1, 30), datetime(2024, 11, 3, 1, 30),
    ]


def test_parse_time(spark):
    got = column(spark, ["2024-01-02 03:04:05", "2024-01-02T03:04:05", "nonsense", None], "string", times.parse_time)
    assert got == [datetime(2024, 1, 2, 3, 4, 5)] * 2 + [None, None]


def test_zoned_clock_is_read_as_utc():
    new_york = datetime.fromisoformat("2024-01-01T05:20:00-05:00")
    assert times.as_datetime(new_york) == datetime(2024, 1, 1, 10, 20)
    assert times.next_hour(new_york) == times.clock_ceil(new_york) == datetime(2024, 1, 1, 11)


def test_as_datetime():
    assert times.as_datetime("2024-01-02T03:00:00") == datetime(2024, 1, 2, 3)
    with pytest.raises(ValueError):
        times.as_datetime(20240102)


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Around both clock changes of New York: hours that don't exist there, or exist twice.
CHANGES = [datetime(2024, 3, 10, 1, 59, 59, 999_999), datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30), datetime(1969, 12, 31, 23, 59, 59, 5)]


def test_wall_times_know_no_session_zone(new_york):
    hours = [t.replace(minute=0, second=0, microsecond=0) for t in CHANGES]
    kind = "timestamp_ntz"
    assert column(new_york, CHANGES, kind, times.floor_hour) == hours
    assert column(new_york, CHANGES, kind, times.next_hour_of) == [h + timedelta(hours=1) for h in hours]
    assert column(new_york, hours, kind, times.ceil_hour) == hours
    assert column(new_york, CHANGES, kind, times.month_of) == [datetime(t.year, t.month, 1) for t in CHANGES]
    assert column(new_york, CHANGES, kind, lambda t: times.drop_zone(times.utc_instant(t))) == CHANGES
    texts = [t.isoformat(sep=" ") for t in CHANGES]
    assert column(new_york, texts, "string", times.parse_time) == CHANGES
    assert column(new_york, [None], kind, times.floor_hour) == column(new_york, [None], kind, times.month_of) == [None]


def test_stream_equals_batch_in_another_zone(new_york):
    from demandgrid.operators.series import hourly_counts
    from demandgrid.session import scratch_path
    from demandgrid.streaming import hourly

    rows = [(t, i % 2) for i, t in enumerate(CHANGES[:3] * 3)]
    rides = new_york.createDataFrame(rows, "pickup_datetime timestamp_ntz, pickup_location_id bigint")
    path, out = scratch_path(new_york, "rides"), scratch_path(new_york, "updates")
    rides.write.parquet(path)
    stream = hourly.hourly_count_stream(hourly.ride_stream(new_york, path, rides.schema), "900 days")
    hourly.write_updates(stream, out, scratch_path(new_york, "state")).awaitTermination()
    got = {tuple(r) for r in hourly.read_updates(new_york, out).collect()}
    assert got == {tuple(r) for r in hourly_counts(rides).collect()}
