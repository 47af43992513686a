"""Packed series: the windows of the filled grid, without its rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from demandgrid.operators import windows
from demandgrid.operators.series import hourly_series

START = datetime(2024, 1, 1)


def sparse(seed, hours=400, locations=5, n=120):
    r = random.Random(seed)
    return [(START + timedelta(minutes=r.randrange(hours * 60)), r.randrange(locations)) for _ in range(n)]


def rows(df):
    return sorted((r.pickup_location_id, r.pickup_hour, tuple(r.lags), r.target) for r in df.collect())


@pytest.mark.parametrize(("size", "step"), [(1, 1), (6, 24), (24, 24), (30, 7), (168, 168), (399, 1), (500, 3)])
def test_same_windows_as_of_rows(rides_frame, monkeypatch, size, step):
    rides = rides_frame(sparse(size) + [(None, 1), (START, None), (START + timedelta(hours=399), 0)])
    want = windows.training_windows(hourly_series(rides), "rides", size, step)
    packed = windows.training_windows(hourly_series(rides, packed=True), "rides", size, step)
    assert rows(packed) == rows(want)
    assert packed.dtypes == want.dtypes
    monkeypatch.setattr(windows, "BATCH_VALUES", 50)  # many short runs of windows
    assert rows(windows.training_windows(hourly_series(rides, packed=True), "rides", size, step)) == rows(want)


def test_bounds_and_silent_locations(spark, rides_frame):
    rides, known = rides_frame(sparse(3)), spark.createDataFrame([(2,), (77,), (77,)], "pickup_location_id bigint")
    for bounds in ({"lo": START + timedelta(hours=30), "hi": START + timedelta(hours=90)}, {"lo": START - timedelta(hours=9)}, {}):
        want, packed = (
            windows.training_windows(hourly_series(rides, packed=p, locations=known, **bounds), "rides", 24, 5) for p in (False, True)
        )
        assert rows(packed) == rows(want) and any(r[0] == 77 for r in rows(packed))


def test_empty(rides_frame):
    assert windows.training_windows(hourly_series(rides_frame([]), packed=True), "rides", 3, 1).count() == 0


def test_one_row_a_location_and_no_sorted_grid(rides_frame):
    rides = rides_frame(sparse(4))
    packed = hourly_series(rides, packed=True)
    assert packed.count() == 5 and max(len(r.rides) for r in packed.collect()) <= 120
    plan = windows.training_windows(packed, "rides", 24, 24)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("REPARTITION_BY_NUM")[0]
    assert "Sort" not in above.replace("SortAggregate", "").replace("sort_array", "") and "Window" not in above and "Generate" not in above


def test_packed_series_are_not_padded(rides_frame):
    with pytest.raises(ValueError):
        windows.training_windows(hourly_series(rides_frame(sparse(5)), packed=True), "rides", 3, 1, pad_short=True)
