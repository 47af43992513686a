"""Windows of rows that move as runs are those of the rows one by one."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import windows
from demandgrid.plans import jobs
from demandgrid.session import scratch_path
from demandgrid.sources.store import FEATURES, KeyedTable

START = datetime(2024, 1, 1)


def rows(df):
    return sorted(((r.pickup_location_id, r.pickup_hour, tuple(r.lags), r.target) for r in df.collect()), key=str)


@pytest.mark.parametrize(("size", "step"), [(1, 1), (6, 24), (12, 5), (30, 7), (200, 1)])
@pytest.mark.parametrize("order", ["stored", "mixed"])
def test_same_windows(hourly_frame, monkeypatch, size, step, order):
    r = random.Random(size)
    df = hourly_frame({loc: [r.randrange(9) for _ in range(n)] for loc, n in ((1, 411), (2, 200), (3, 201), (4, 3), (5, 1))})
    df = df.where((F.col("pickup_location_id") != 1) | (F.hour("pickup_hour") != 5))  # missing hours: windows count rows
    df = df.withColumn("rides", F.when(F.col("rides") > 0, F.col("rides")))  # a value may be null
    df = df.withColumn("pickup_location_id", F.when(F.col("pickup_location_id") != 2, F.col("pickup_location_id")))
    df = df.repartition(3, F.to_date("pickup_hour")).sortWithinPartitions("pickup_location_id", "pickup_hour") if order == "stored" else df.orderBy(F.rand(1))
    want = windows.training_windows(df, "rides", size, step)
    got = windows.training_windows(df, "rides", size, step, runs=True)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)
    monkeypatch.setattr(windows, "BATCH_VALUES", 40)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # series go over batches
    try:
        assert rows(windows.training_windows(df, "rides", size, step, runs=True)) == rows(want)
    finally:
        df.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_rows(hourly_frame):
    assert windows.training_windows(hourly_frame({1: [1]}).limit(0), "rides", 3, 1, runs=True).count() == 0


def test_a_stored_day_moves_as_one_row(spark, hourly_frame, monkeypatch):
    table = KeyedTable.create_or_get(spark, scratch_path(spark, "store"), FEATURES)
    table.upsert(hourly_frame({loc: list(range(240)) for loc in range(20)}))
    stored = table.read().select("pickup_location_id", "pickup_hour", F.col("rides").alias("v"))
    runs = stored.mapInArrow(windows._runs_of_rows(), "pickup_location_id bigint, pickup_hour timestamp_ntz, v array<bigint>")
    assert runs.count() == 20 * 10
    seen = []
    write = jobs.materialize
    monkeypatch.setattr(jobs, "materialize", lambda made, label: seen.append(made) or write(made, label))
    jobs.training_job(spark, table.path.rsplit("/", 1)[0], START + timedelta(days=9), START + timedelta(days=5), window=6, step=24, lags_only=True, maxIter=1)
    assert len(seen) == 1  # written once for the fit, the report and the registry
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan and plan.count("MapInArrow") == 2
