from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import profiles, quality
from demandgrid.operators.quantiles import exact_quantiles
from demandgrid.operators.quantiles import exact_quantiles_of as quantiles_of
from demandgrid.schemas import TRIPS, ZONES
from demandgrid.session import materialize, scratch_path
from demandgrid.sources import trips, zones

JAN = datetime(2024, 1, 10, 12)
HOUR = timedelta(hours=1)


def trip(pickup=JAN, length=HOUR, amount=10.0, location=50, filed=(2024, 1)):
    return (pickup, pickup + length, amount, location, *filed)


def passing(spark, rows):
    return quality.filter_trips(spark.createDataFrame(rows, TRIPS))


def test_duration_bounds(spark):
    second = timedelta(seconds=1)
    lengths = [timedelta(0), -second, second, 5 * HOUR, 5 * HOUR + second]
    flags = quality.flag_trips(spark.createDataFrame([trip(length=d) for d in lengths], TRIPS))
    got = {(r.tpep_dropoff_datetime - r.tpep_pickup_datetime): r.ok_duration for r in flags.collect()}
    assert [got[d] for d in lengths] == [False, False, True, True, False]


def test_amount_bounds_and_nulls(spark):
    amounts = [0.0, -3.0, float("nan"), None, 10.0]
    flags = quality.flag_trips(spark.createDataFrame([trip(amount=a) for a in amounts], TRIPS)).collect()
    ok = [r.total_amount for r in flags if r.ok_amount]
    # The limit is 0.999 of the way to the greatest of three amounts, so just below it.
    assert ok == [] and all(r.amount_limit < 10.0 for r in flags)
    same = quality.flag_trips(spark.createDataFrame([trip(amount=7.0)] * 5, TRIPS)).collect()
    assert all(r.ok_amount and r.amount_limit == 7.0 for r in same)


def test_locations(spark):
    rows = [trip(location=x) for x in (1, 264, 265, 2, None)]
    got = [r.pickup_location_id for r in passing(spark, rows).collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == [2, None]


def test_period_and_december(spark):
    rows = [
        trip(datetime(2024, 1, 1)), trip(datetime(2024, 2, 1)), trip(datetime(2023, 12, 31, 23, 59)),
        trip(datetime(2024, 12, 31, 23), filed=(2024, 12)), trip(datetime(2025, 1, 1), filed=(2024, 12)),
    ]
    got = sorted(r.pickup_datetime for r in passing(spark, rows).collect())
    assert got == [datetime(2024, 1, 1), datetime(2024, 12, 31, 23)]


def test_limit_is_taken_before_other_rules_and_per_filing_month(spark):
    # The huge amount fails the duration rule but still raises January's limit above 100.
    january = [trip(amount=10.0)] * 8 + [trip(amount=100.0), trip(amount=1e6, length=timedelta(0))]
    february = [trip(datetime(2024, 2, 5), amount=a, filed=(2024, 2)) for a in (1.0, 1.0, 2.0)]
    stray = [trip(datetime(2024, 2, 6), amount=50.0)]
    limits = {r.month: r.amount_limit for r in quality.amount_limits(spark.createDataFrame(january + february + stray, TRIPS)).collect()}
    assert limits[1] == pytest.approx(np.quantile([10.0] * 8 + [50.0, 100.0, 1e6], 0.999))
    assert limits[2] == pytest.approx(np.quantile([1.0, 1.0, 2.0], 0.999))
    report = {r.month: r for r in quality.reject_report(spark.createDataFrame(january + february + stray, TRIPS)).collect()}
    assert report[1].total_records == 11 and report[1].valid_records == 9
    assert (report[1].rejected_duration, report[1].rejected_amount, report[1].rejected_period) == (1, 1, 1)
    assert report[2].rejected_amount == 1 and report[2].percent_dropped == pytest.approx(100 / 3)


def test_stored_limits_give_the_same_rides(spark):
    trips_ = spark.createDataFrame([trip(amount=float(a)) for a in range(1, 40)], TRIPS)
    limits = materialize(quality.amount_limits(trips_), "limits")
    assert quality.filter_trips(trips_, limits=limits).count() == quality.filter_trips(trips_).count() == 38
    assert quality.reject_report(trips_, limits=limits).collect() == quality.reject_report(trips_).collect()


def test_month_without_amounts(spark):
    rows = [trip(amount=None), trip(datetime(2024, 3, 1), amount=None)]
    row = quality.reject_report(spark.createDataFrame(rows, TRIPS)).first()
    assert (row.total_records, row.rejected_amount, row.rejected_period) == (2, 2, 1)


def test_quantiles_against_numpy(spark):
    rng = np.random.default_rng(7)
    probs = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0]
    for values in (
        rng.normal(size=20_000), rng.integers(0, 5, 3000).astype(float), rng.lognormal(3, 2, 5001),
        np.array([4.0]), np.array([1.0, 9.0]), np.concatenate([np.zeros(9000), np.ones(10)]),
    ):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "x double").repartition(4)
        row = exact_quantiles(df, "x", probs).first()
        assert row.n == len(values)
        assert row.quantiles == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-12)


def test_quantiles_next_to_infinities(spark):
    inf = float("inf")
    got = lambda values, p: exact_quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", [p]).first().quantiles[0]
    assert got([1.0, 2.0, inf], 0.5) == 2.0 and got([1.0, 2.0, inf], 0.6) == inf and got([1.0, 2.0, inf], 1.0) == inf
    assert got([-inf, 1.0, 2.0], 0.5) == 1.0 and got([-inf, 1.0, 2.0], 0.25) == -inf
    assert got([-inf, inf], 0.4) == -inf and got([-inf, inf], 0.6) == inf and got([inf] * 9, 0.3) == inf


@pytest.mark.parametrize("outlier", [1e9, -1e9])
def test_one_huge_value_leaves_slots_small(spark, outlier):
    from demandgrid.operators import quantiles

    n, p = 200_000, 0.999 if outlier > 0 else 0.001
    df = spark.range(n).select((F.xxhash64("id") % 1_000_000_007 / 1_000.0).alias("v")).union(spark.createDataFrame([(outlier,)], "v double"))
    brackets = quantiles._brackets([p])
    cuts = quantiles._cuts(df, [], [q for pair in brackets for q in pair])
    slots = df.crossJoin(cuts).groupBy(quantiles._slot(brackets).alias("slot")).agg(F.count("*").alias("c")).orderBy("slot").collect()
    upto, rank = 0, int(p * n)
    for r in slots:
        upto += r.c
        if upto > rank:
            assert r.c < 100 * n / 1_000_000 + 10
            break
    values = sorted(r.v for r in df.collect())
    assert exact_quantiles(df, "v", [p]).first().quantiles[0] == pytest.approx(float(np.quantile(values, p)))


def test_quantiles_of_several_columns(spark):
    df = spark.createDataFrame([(float(i), i * i, None if i % 2 else 5.0) for i in range(101)], "a double, b bigint, c double")
    got = {r.measure: (r.n, r.quantiles) for r in quantiles_of(df, ["a", "b", "c"], [0.5, 0.9]).collect()}
    assert got == {"a": (101, [50.0, 90.0]), "b": (101, [2500.0, 8100.0]), "c": (51, [5.0, 5.0])}


def test_stored_limits_are_worked_out_once(spark, monkeypatch):
    path, limits = scratch_path(spark, "trips"), scratch_path(spark, "limits")
    rows = [trip(JAN, amount=float(i)) for i in range(1, 50)] + [trip(datetime(2024, 2, 3), amount=9.0, filed=(2024, 2))]
    trips.write_trips(spark.createDataFrame(rows, TRIPS), path)
    months = [(2024, 1), (2024, 2), (2024, 3)]
    first = {tuple(r) for r in trips.stored_limits(spark, path, limits, months[:1]).collect()}
    got = trips.stored_limits(spark, path, limits, months)
    assert first < {tuple(r) for r in got.collect()} == {tuple(r) for r in quality.amount_limits(trips.read_trips(spark, path)).collect()}
    assert trips.load_rides(spark, path, months, limits=got).count() == trips.load_rides(spark, path, months).count()

    def again(*_):
        raise AssertionError("worked out again")

    monkeypatch.setattr(trips, "amount_limits", again)
    assert trips.stored_limits(spark, path, limits, months[:2]).count() == 2


def test_quantiles_with_a_poor_sketch(spark, monkeypatch):
    """The sketch only steers the work: enclosures that miss the ranks altogether change nothing."""
    from demandgrid.operators import quantiles

    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(quantiles, "_cuts", lambda rows, by, ends: rows.limit(1).select(F.array(*[F.lit(400.0 + i) for i in range(len(ends))]).alias("cuts")))
    assert exact_quantiles(df, "x", [0.1, 0.5, 0.9]).first().quantiles == pytest.approx([99.9, 499.5, 899.1])


def test_quantiles_by_month_with_one_heavy_month(spark):
    rows = [(2024, 1, float(i)) for i in range(5000)] + [(2024, m, float(m)) for m in range(2, 13)]
    got = exact_quantiles(spark.createDataFrame(rows, "year int, month int, x double"), "x", [0.5], ["year", "month"])
    by_month = {r.month: r.quantiles[0] for r in got.collect()}
    assert by_month == {1: 2499.5, **{m: float(m) for m in range(2, 13)}}


def test_quantile_buckets_must_be_calendar_columns(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(3), "id", [0.5], ["id"])


def test_bad_filing_month_fails_the_period_rule(spark):
    row = quality.reject_report(spark.createDataFrame([trip(filed=(2024, 13))], TRIPS)).first()
    assert (row.valid_records, row.rejected_period) == (0, 1)


def test_empty_input(spark):
    empty = spark.createDataFrame([], TRIPS)
    assert quality.filter_trips(empty).count() == 0
    assert exact_quantiles(empty, "total_amount", [0.5]).first().asDict() == {"n": 0, "quantiles": [None]}
    assert exact_quantiles(empty, "total_amount", [0.5], ["year"]).count() == 0
    assert profiles.describe(empty, "total_amount").first()["count"] == 0
    assert profiles.histogram(empty, "total_amount").count() == 0


def test_profiles(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    row = profiles.describe(df, "x").first()
    assert (row["count"], row["min"], row["p25"], row["p50"], row["p75"], row["max"]) == (5, 1.0, 2.0, 3.0, 4.0, 100.0)
    box = profiles.box_stats(df, "x").first()
    assert (box.q1, box.q3, box.whisker_low, box.whisker_high, box.outliers_high) == (2.0, 4.0, 1.0, 4.0, 1)
    bins = {r.bin: r.rows for r in profiles.histogram(df, "x", 3).collect()}
    assert bins == {0: 4, 1: 0, 2: 1}
    info = {r.column_name: (r.type, r.non_null, r.rows) for r in profiles.column_profile(df).collect()}
    assert info == {"x": ("double", 5, 6)}
    one = [r.side for r in profiles.extremes(df.where("x is not null"), ["x"], 2).orderBy("x").collect()]
    assert one == ["first", "first", "last", "last"]
    assert profiles.pick_one(df, ["x"]).collect() == profiles.pick_one(df.repartition(3), ["x"]).collect()


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "x double")
    rows = profiles.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r.rows for r in rows] == [0, 0, 3, 0] and rows[0].lower == 4.5


def test_month_files_are_pruned_and_missing_months_reported(spark):
    path = scratch_path(spark, "trips")
    rows = [trip(datetime(2023, m, 5), filed=(2023, m)) for m in (1, 2, 3)] + [trip(filed=(2024, 1))] * 3
    trips.write_trips(spark.createDataFrame(rows, TRIPS), path)
    months = trips.months_of_year(2023, [1, 2, 7])
    df = trips.read_trips(spark, path, months)
    assert df.count() == 2
    files = [f for f in df.inputFiles() if "year=2024" in f or "month=3" in f]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan, files
    assert [(r.year, r.month) for r in trips.missing_months(spark, path, months).collect()] == [(2023, 7)]
    assert trips.load_rides(spark, path, trips.months_of_year(2023) + trips.months_of_year(2024)).count() == 6
    with pytest.raises(ValueError):
        trips.load_rides_or_fail(spark, path, [(2022, 5)])


def test_scans_read_only_what_they_need(spark):
    path = scratch_path(spark, "trips")
    trips.write_trips(spark.createDataFrame([trip(amount=float(a)) for a in range(5)], TRIPS), path)
    df = trips.read_trips(spark, path, [(2024, 1)])
    plan = quality.amount_limits(df)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 3
    for scan in scans:
        assert "ReadSchema: struct<total_amount:double>" in scan and "IsNotNull(total_amount)" in scan
        assert "PartitionFilters: []" not in scan


def test_month_arguments():
    assert trips.months_of_year(2023) == [(2023, m) for m in range(1, 13)]
    for bad in ([0], [13], ["1"]):
        with pytest.raises(ValueError):
            trips.months_of_year(2023, bad)
    assert trips.months_between(datetime(2023, 11, 30), datetime(2024, 2, 1)) == [(2023, 11), (2023, 12), (2024, 1)]


def test_zone_file(spark):
    path = scratch_path(spark, "zones_csv")
    lines = [
        "LocationID,Borough,Zone,service_zone", '56,Queens,Corona,Boro Zone', '57,Queens,Corona,Boro Zone',
        '103,Manhattan,"Governor\'s Island/Ellis Island/Liberty Island",Yellow Zone', "264,Unknown,N/A,N/A", "265,N/A,Outside of NYC,N/A",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    dim = zones.zones_csv_to_parquet(spark, path, scratch_path(spark, "zones"))
    assert dim.schema.names == ZONES.names and dim.count() == 5
    assert dim.where("Zone is null").first().LocationID == 264 and dim.where("Borough is null").first().LocationID == 265
    facts = spark.createDataFrame([(56,), (57,), (264,), (999,), (None,)], "pickup_location_id int")
    names = zones.zone_names(dim)
    got = {r.pickup_location_id: r.zone for r in zones.add_zone(facts, names).collect()}
    assert got == {56: "Corona", 57: "Corona", 264: None, 999: None, None: None}
    lower = zones.zone_names(dim.withColumnRenamed("Zone", "zone"))
    assert lower.columns == ["pickup_location_id", "zone"]
    with pytest.raises(ValueError):
        zones.zone_names(dim.drop("Zone"))
    demand = spark.createDataFrame([(56, 3.0)], "pickup_location_id int, predicted_demand double")
    assert {r.pickup_location_id: r.predicted_demand for r in zones.zone_demand(names, demand).collect()} == {
        56: 3.0, 57: 0.0, 103: 0.0, 264: 0.0, 265: 0.0,
    }
