"""Hours given out as runs: a counted hour and the empty ones after it are one row."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest

from demandgrid.plans import queries
from demandgrid.streaming import hourly
from tests.test_stream_buckets import State, run
from tests.test_stream_series import Feed

START = datetime(2024, 1, 1)
SCHEMA = "pickup_datetime timestamp_ntz, pickup_location_id bigint"


@pytest.mark.parametrize("start", [100, None])
@pytest.mark.parametrize("seed", range(4))
def test_runs_hold_the_rows(start, seed):
    r, watermark, batches = random.Random(seed), 0, []
    for k in range(8):
        seen = [(r.choice([5, 9, 2**60 + 1, -4][: 1 + k]), 100 + r.randrange(8 * k, 8 * k + 20) - r.randrange(12), r.randrange(1, 4)) for _ in range(1 + r.randrange(9))]
        batches += [(watermark, seen), (watermark := max([watermark, *(h - 2 for _, h, _ in seen)]), [])]
    batches.append((watermark + 30, []))
    step, state, got, given = hourly._close_hours(start, 6, packed=True), State(), [], 0
    for at, rows in batches:
        state.watermark = at * 3_600_000
        part = pd.DataFrame(rows, columns=["location", "hour", "n"], dtype="int64")
        for frame in step((3,), iter([part]), state):
            given += len(frame)
            got += [(x.location, x.hour + i, x.rides if i == 0 else 0, x.late) for x in frame.itertuples() for i in range(x.hours)]
    assert sorted(got) == sorted(run(batches, start)[0]) and given < len(got)


def test_the_stored_table_grows_with_the_rides(spark):
    rides = [(START + timedelta(hours=250 * i + place), place) for place in range(3) for i in range(3)]
    late = [(START + timedelta(hours=1, minutes=5), 1), (START + timedelta(hours=600), 2)]
    closing = [(START + timedelta(hours=723), None)]
    parts = [spark.createDataFrame(p, SCHEMA) for p in (rides[:4], rides[4:], late, closing)]
    got = queries._arriving(spark, parts, START)
    folders = {os.path.dirname(f) for f in got.inputFiles()}
    assert spark.read.parquet(*folders).count() <= len(rides) + len(late) + 3 * len(parts)
    rows = [(r.pickup_hour, r.pickup_location_id, r.rides, r.late) for r in got.collect()]
    feed = Feed(spark)
    for p in (rides[:4], rides[4:], late, closing):
        feed.arrive(p).run()
    assert sorted(rows) == sorted(feed.rows()) and len(rows) > 3 * 700
    assert sum(n for *_, n, _ in rows) == len(rides) + len(late) and any(late for *_, late in rows)
