from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from demandgrid.operators import series

START = datetime(2024, 1, 1)


def at(hours, minutes=0):
    return START + timedelta(hours=hours, minutes=minutes)


def cells(df):
    return {(r.pickup_location_id, r.pickup_hour): r.rides for r in df.collect()}


def test_counts_skip_null_keys(rides_frame):
    rides = rides_frame([(at(0, 5), 1), (at(0, 59), 1), (at(1), 1), (at(0), None), (None, 1)])
    assert cells(series.hourly_counts(rides)) == {(1, at(0)): 2, (1, at(1)): 1}


def test_gap_small(rides_frame):
    rides = rides_frame([(at(0, 5), 1), (at(4, 5), 1), (at(2, 5), 2)])
    got = cells(series.hourly_series(rides))
    assert len(got) == 10 and sum(got.values()) == 3
    assert got[(2, at(0))] == 0 and got[(2, at(2))] == 1 and got[(1, at(4))] == 1


def test_gap_edges_with_options(rides_frame, spark):
    rides = rides_frame([(at(1, 5), 1), (at(2, 5), 1), (at(9), 1)])
    assert min(t for _, t in cells(series.hourly_series(rides))) == at(1)
    places = spark.createDataFrame([(1,), (7,)], "pickup_location_id bigint")
    got = cells(series.hourly_series(rides, lo=at(0), hi=at(3), locations=places))
    assert len(got) == 8 and sum(got.values()) == 2 and got[(7, at(0))] == 0
    only_lo = cells(series.hourly_series(rides, lo=at(0), locations=places))
    assert len(only_lo) == 20 and sum(only_lo.values()) == 3


def test_fill_is_idempotent_and_keeps_the_sum(rides_frame):
    rng = random.Random(3)
    rides = rides_frame([(at(rng.randrange(200), rng.randrange(60)), rng.choice([1, 1, 1, 5, 9])) for _ in range(300)])
    once = series.hourly_series(rides)
    got = cells(once)
    assert sum(got.values()) == 300 and len(got) == once.count()
    hours = {t for _, t in got}
    assert len(got) == 3 * len(hours) and len(hours) == (max(hours) - min(hours)).total_seconds() // 3600 + 1
    assert cells(series.fill_hours(once)) == got


def test_fill_reuses_the_count_exchange(rides_frame):
    df = series.hourly_series(rides_frame([(at(0), 1), (at(5), 2)]).repartition(2))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_empty(rides_frame):
    assert series.hourly_series(rides_frame([])).count() == 0


def test_replay_over_a_year_end(rides_frame):
    rides = rides_frame([(datetime(2023, 12, 31, 23), 1), (datetime(2024, 1, 1), 1), (datetime(2024, 1, 2), 2)])
    got = series.replay(rides, "2024-12-29T00:00:00", datetime(2024, 12, 31)).collect()
    assert sorted(r.pickup_datetime for r in got) == [datetime(2024, 12, 29, 23), datetime(2024, 12, 30)]
    with pytest.raises(ValueError):
        series.replay(rides, "2024-12-29", "2024-12-29")
    with pytest.raises(ValueError):
        series.replay(rides, 5, "2024-12-29")


def test_rows_by_month(rides_frame):
    rides = rides_frame([(datetime(2024, m, 3), 1) for m in (1, 2, 2, 3)])
    got = series.rows_by_month(rides, "pickup_datetime", datetime(2024, 2, 20), datetime(2024, 3, 1)).collect()
    assert {r.year_month.month: r["rows"] for r in got} == {2: 2, 3: 1}
