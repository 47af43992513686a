from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import windows

START = datetime(2024, 1, 1)


def brute(values, size, step):
    """(offset, lags, target) by plain slicing."""
    return [(i, values[i : i + size], values[i + size]) for i in range(0, len(values) - size, step)]


def collected(df):
    return sorted((r.pickup_location_id, r.pickup_hour, list(r.lags), r.target) for r in df.collect())


def expected(series, size, step):
    return sorted(
        (loc, START + timedelta(hours=i + size), lags, target)
        for loc, values in series.items()
        for i, lags, target in brute(values, size, step)
    )


def test_lengths_around_the_window(hourly_frame):
    df = hourly_frame({1: list(range(13)), 2: list(range(12)), 3: list(range(17))})
    assert collected(windows.training_windows(df, "rides", 12, 2)) == expected(
        {1: list(range(13)), 3: list(range(17))}, 12, 2
    )


def test_short_series_are_reported(hourly_frame):
    df = hourly_frame({1: [0] * 13, 2: [0] * 12, 3: [0]})
    assert {r.pickup_location_id: r["rows"] for r in windows.short_series(df, 12).collect()} == {2: 12, 3: 1}


def test_window_and_step_must_be_positive(hourly_frame):
    with pytest.raises(ValueError):
        windows.training_windows(hourly_frame({1: [1, 2]}), "rides", 0)
    with pytest.raises(ValueError):
        windows.training_windows(hourly_frame({1: [1, 2]}).drop("rides"))


@pytest.mark.parametrize("chunk", [1, 7, 20, 8760])
@pytest.mark.parametrize("size,step", [(1, 1), (5, 1), (12, 5), (4, 9), (30, 7)])
def test_chunks_do_not_change_windows(hourly_frame, chunk, size, step):
    rng = random.Random(size * 100 + step)
    series = {loc: [rng.randrange(50) for _ in range(n)] for loc, n in ((1, 61), (2, 31), (3, 3))}
    shuffled = hourly_frame(series).orderBy(F.rand(1)).repartition(3)
    got = collected(windows.training_windows(shuffled, "rides", size, step, chunk=chunk))
    assert got == expected(series, size, step)


def test_anchor(hourly_frame):
    """695 hours give the one oldest window, 696 give two; the end anchor gives the newest."""
    for n, starts in ((695, 1), (696, 2)):
        values = [i % 97 for i in range(n)]
        df = hourly_frame({1: values})
        w = windows.scoring_windows(df, "rides", 672, 23).orderBy("pickup_hour").collect()
        assert len(w) == starts and w[0].pickup_hour == START + timedelta(hours=672) and list(w[0].lags) == values[:672]
        last = windows.scoring_windows(df, "rides", 672, anchor="end").collect()
        assert len(last) == 1 and last[0].pickup_hour == START + timedelta(hours=n) and list(last[0].lags) == values[-672:]
    with pytest.raises(ValueError):
        windows.scoring_windows(df, anchor="middle")


def test_padding(hourly_frame):
    df = hourly_frame({1: [5], 2: [1, 2, 3, 4, 5], 3: list(range(14))})
    got = {}
    for r in windows.training_windows(df, "rides", 12, 1, pad_short=True).collect():
        got.setdefault(r.pickup_location_id, []).append((list(r.lags), r.target))
    assert got[1] == [([5] * 12, 5)]
    assert got[2] == [([1] * 8 + [1, 2, 3, 4], 5)]
    assert len(got[3]) == 2


def test_wide_narrow_and_single(hourly_frame):
    df = hourly_frame({1: list(range(20)), 2: list(range(100, 120))}).withColumn(
        "zone", F.when(F.col("pickup_location_id") == 1, "A").otherwise("B")
    )
    w = windows.training_windows(df, "rides", 12, 3)
    wide = windows.widen(w, 12)
    assert wide.columns[:12] == [f"rides_t-{k}" for k in range(12, 0, -1)]
    assert windows.lag_columns(wide) == wide.columns[:12]
    assert collected(windows.narrow(wide)) == collected(w)
    by_id = windows.single_series_windows(df, 2, "rides", 12, 3)
    by_name = windows.single_series_windows(df, None, "rides", 12, 3, location_name="B")
    assert by_id.collect() == by_name.collect() and by_id.count() == 3
    first = by_id.orderBy("pickup_hour").first()
    assert [first[f"feature_{i}"] for i in range(1, 13)] == list(range(100, 112)) and first.target == 112


def test_unpivot(hourly_frame):
    w = windows.training_windows(hourly_frame({1: list(range(10))}), "rides", 4, 100)
    rows = windows.unpivot(w).orderBy("datetime").collect()
    assert [(r.datetime - START) // timedelta(hours=1) for r in rows] == [0, 1, 2, 3, 4]
    assert [r.rides for r in rows] == [0.0, 1.0, 2.0, 3.0, 4.0]
    shown = windows.unpivot(w, F.lit(99.5)).orderBy("datetime").collect()
    assert shown[-1].rides == 99.5


def test_seasonal_lags_look_back_whole_weeks(hourly_frame):
    values = [(7 * i) % 1000 for i in range(700)]
    rows = windows.seasonal_lags(hourly_frame({1: values})).collect()
    for r in rows:
        i = (r.pickup_hour - START) // timedelta(hours=1)
        assert r.history == i
        for k in (1, 2, 3, 4):
            want = values[i - 168 * k] if i >= 168 * k else None
            assert r[f"rides_t-{168 * k}"] == want


def test_split(hourly_frame):
    df = hourly_frame({1: list(range(10))})
    train, test = windows.split_by_time(df, START + timedelta(hours=4))
    assert train.count() == 4 and test.count() == 6


def test_fill_and_windows_need_no_further_shuffle(rides_frame):
    """After the exchange by location, numbering, chunking and collecting run where the rows are."""
    from demandgrid.operators.series import hourly_series

    rides = rides_frame([(START + timedelta(hours=h), loc) for h in range(30) for loc in (1, 2)])
    plan = windows.training_windows(hourly_series(rides), "rides", 4, 2)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("REPARTITION_BY_NUM")[0]
    assert above.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize(("window", "step", "chunk"), [(5, 1, 20), (7, 3, 30), (3, 11, 40), (12, 1, None)])
def test_spread_series_give_the_same_windows(spark, hourly_frame, window, step, chunk):
    df = hourly_frame({1: list(range(300)), 2: [7] * 3, 3: list(range(90, 0, -1)), 4: list(range(40))}).repartition(5)
    plain, spread = (windows.training_windows(df, "rides", window, step, chunk=chunk, spread=s) for s in (False, True))
    assert plain.count() > 0 and sorted(spread.collect(), key=str) == sorted(plain.collect(), key=str)


def test_spread_series_without_rows_or_ids(spark, hourly_frame):
    empty = hourly_frame({1: [1]}).limit(0)
    assert windows.training_windows(empty, "rides", 3, 1, spread=True).count() == 0
    nameless = hourly_frame({1: list(range(9))}).withColumn("pickup_location_id", F.lit(None).cast("bigint"))
    assert windows.training_windows(nameless, "rides", 3, 1, spread=True).count() == 6


def test_one_long_series_spans_the_tasks(spark):
    hours = spark.range(40_000).select(
        F.lit(1).cast("bigint").alias("pickup_location_id"), F.col("id").alias("rides"),
        (F.lit("1990-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("pickup_hour"),
    )
    made = windows.training_windows(hours, "rides", 24, 1, chunk=100, spread=True)
    by_task = [r["n"] for r in made.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(by_task) == 40_000 - 24 and len(by_task) == 4 and max(by_task) <= 2 * sorted(by_task)[2]
    single = windows.single_series_windows(hours, 1, "rides", 3, 1)
    assert single.where("feature_1 + 3 <> target or feature_2 + 2 <> target").count() == 0
