"""The registered inference query predicts for all locations."""

from __future__ import annotations

import os
from collections import defaultdict
from datetime import timedelta

import pytest

from demandgrid.functions import times
from demandgrid.plans import inputs, jobs, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_every_location_gets_a_prediction(spark):
    hour = times.next_hour(queries.REPLAY_NOW)
    weeks = {hour - timedelta(weeks=k) for k in (1, 2, 3, 4)}
    want = defaultdict(int)
    for r in jobs.feature_rides(inputs.rides(spark, SF), queries.REPLAY_NOW, days=29).collect():
        want[r["pickup_location_id"]] += r["rides"] * (r["pickup_hour"] in weeks)
    got = {r["pickup_location_id"]: r["predicted_demand"] for r in queries.inference_job(spark, SF).collect()}
    assert {location % 10 for location in want} >= {3, 7}
    assert got == {location: round(total / 4) for location, total in want.items()}
