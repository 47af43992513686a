"""Locations of a bucket are closed by one call, with the rows that each would get alone."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from demandgrid.session import scratch_path
from demandgrid.streaming import hourly


class State:
    """A group state in memory."""

    def __init__(self):
        self.exists, self.get, self.watermark, self.timeout = False, None, 0, None

    def update(self, value):
        self.exists, self.get = True, value

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.watermark

    def setTimeoutTimestamp(self, at):  # noqa: N802
        self.timeout = at


def run(batches, start, frame_rows=hourly.FRAME_ROWS):
    """Rows given out, the sizes of the frames, and the timer after each batch; a batch is (watermark in hours, rows)."""
    step, state, out, sizes, timers = hourly._close_hours(start, frame_rows), State(), [], [], []
    for watermark, rows in batches:
        state.watermark = watermark * 3_600_000
        part = pd.DataFrame(rows, columns=["location", "hour", "n"], dtype="int64")
        for frame in step((3,), iter([part[: len(part) // 2], part[len(part) // 2 :]]), state):
            out += [(r.location, r.hour, r.rides, r.late) for r in frame.itertuples()]
            sizes.append(len(frame))
        timers.append(state.timeout)
    return out, sizes, timers


@pytest.mark.parametrize("start", [100, None])
@pytest.mark.parametrize("seed", range(4))
def test_together_as_alone(start, seed):
    r, watermark, batches = random.Random(seed), 0, []
    for k in range(7):
        seen = [(r.choice([5, 9, 2**60 + 1, -4][: 2 + k]), 100 + r.randrange(8 * k, 8 * k + 20) - r.randrange(12), r.randrange(1, 4)) for _ in range(r.randrange(9))]
        batches.append((watermark, seen))
        watermark = max([watermark, *(h - 2 for _, h, _ in seen)])
    batches.append((watermark + 30, []))
    together = run(batches[next(i for i, (_, rows) in enumerate(batches) if rows) :], start)[0]
    alone = []
    for place in {p for _, rows in batches for p, _, _ in rows}:
        own = [(w, [x for x in rows if x[0] == place]) for w, rows in batches]
        begin = next(i for i, (_, rows) in enumerate(own) if rows)
        alone += run(own[begin:], start)[0]
    assert sorted(together) == sorted(alone) and len(together) > 50
    assert sum(n for *_, n, _ in together) == sum(n for _, rows in batches for *_, n in rows)


def test_frames_are_bounded_and_a_timer_waits_for_the_next_hour():
    rows = [(place, 10, 1) for place in range(40)]
    out, sizes, timers = run([(0, rows), (110, [])], 10, frame_rows=250)
    assert len(out) == 40 * 100 and max(sizes) <= 350 and len(sizes) > 5
    assert timers == [11 * 3_600_000 - 1, 111 * 3_600_000 - 1]


def test_many_locations_share_few_calls(spark):
    start, path = datetime(2024, 1, 1), scratch_path(spark, "incoming")
    rows = [(start + timedelta(minutes=7 * i), (2**60 + 1) * (i % 2) + i) for i in range(3000)] + [(start + timedelta(days=20), None)]
    frame = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, pickup_location_id bigint")
    frame.write.parquet(path)
    out, state = (scratch_path(spark, n) for n in ("out", "state"))
    query = hourly.write_updates(hourly.hourly_series_stream(hourly.ride_stream(spark, path, frame.schema), "2 hours", start), out, state, mode="append")
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= hourly.BUCKETS
    got = spark.read.parquet(out)
    assert got.where("rides > 0").select("pickup_location_id").distinct().count() == 3000
    assert {r.pickup_location_id for r in got.where("rides > 0").collect()} == {p for _, p in rows if p is not None}


def test_late_rows_of_one_location_leave_the_others_of_its_bucket_alone():
    out, _, _ = run([(0, [(1, 10, 1), (2, 11, 1)]), (12, []), (12, [(1, 10, 5), (2, 12, 2), (3, 10, 4)]), (14, [])], 10)
    assert [r for r in out if r[3]] == [(1, 10, 5, True)]
    assert {(place, hour): n for place, hour, n, late in out if not late and n} == {(1, 10): 1, (2, 11): 1, (2, 12): 2, (3, 10): 4}
    assert sorted((place, hour) for place, hour, _, late in out if not late) == [(p, h) for p in (1, 2, 3) for h in range(10, 14)]
