from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import dashboard, models, monitor
from demandgrid.operators.quality import TripRules
from demandgrid.plans import jobs
from demandgrid.schemas import TRIPS
from demandgrid.session import CHECKPOINT_DIR, scratch_path
from demandgrid.sources import store, trips
from demandgrid.streaming import hourly

START = datetime(2024, 1, 1)


@pytest.fixture
def table(spark):
    return store.KeyedTable.create_or_get(spark, scratch_path(spark, "store"), store.FEATURES)


def contents(df):
    return {(r.pickup_location_id, r.pickup_hour): r.rides for r in df.collect()}


def test_upsert_last_write_wins_and_is_idempotent(spark, table, hourly_frame):
    assert table.read().count() == 0
    first, second = hourly_frame({1: [1] * 72, 2: [2] * 72}), hourly_frame({1: [9] * 24, 3: [3] * 2}, START + timedelta(hours=36))
    table.upsert(first)
    table.upsert(second)
    want = {**contents(first), **contents(second)}
    assert contents(table.read()) == want
    table.upsert(second)
    assert contents(table.read()) == want and table.read().count() == len(want)
    again = store.KeyedTable.create_or_get(spark, table.path.rsplit("/", 1)[0], store.FEATURES)
    assert contents(again.read()) == want
    table.upsert(first.limit(0))
    assert contents(table.read()) == want


def test_untouched_dates_are_not_rewritten(spark, table, hourly_frame):
    table.upsert(hourly_frame({1: [1] * 72}))
    files = lambda: {f for f in table.read().inputFiles()}
    before = files()
    table.upsert(hourly_frame({1: [5] * 3}, START + timedelta(days=1)))
    kept = {f for f in before if "2024-01-02" not in f}
    assert kept and kept <= files() and before - files() == before - kept


def folders(table):
    return {v["folder"] for v in table._state()[1].values()}


def test_equal_dates_are_not_written(spark, table, hourly_frame):
    assert len(table.upsert(hourly_frame({1: [1] * 72, 2: [2] * 72}))) == 3
    number, before = table._state()[0], folders(table)
    assert table.upsert(hourly_frame({2: [2] * 72, 1: [1] * 72}).repartition(3)) == []  # equal digests
    assert table.upsert(hourly_frame({2: [2] * 30})) == []  # a part of the stored rows: compared row by row
    assert table._state()[0] == number and folders(table) == before
    assert table.upsert(hourly_frame({1: [1] * 30 + [7], 2: [2] * 60})) == ["2024-01-02"]
    assert contents(table.read())[(1, START + timedelta(hours=30))] == 7 and table.read().count() == 144


def test_a_second_run_of_the_job_writes_nothing(spark):
    root, path = scratch_path(spark, "store"), scratch_path(spark, "trips")
    base = datetime(2025, 1, 1, 10) - timedelta(weeks=52)
    rows = [(base - timedelta(hours=h), base - timedelta(hours=h - 1), 9.0, h % 3 + 2, *(base - timedelta(hours=h)).timetuple()[:2]) for h in range(1, 200)]
    trips.write_trips(spark.createDataFrame(rows, TRIPS), path)
    run = lambda: jobs.feature_job(spark, path, root, datetime(2025, 1, 1, 9, 20), rules=TripRules(amount_quantile=1.0))
    first = run()._state()
    assert run()._state() == first and first[0] == 1


def test_bucketed_tables_are_joined_in_place(spark, hourly_frame):
    root = scratch_path(spark, "store")
    specs = [replace(t, buckets=3) for t in (store.FEATURES, store.FORECASTS)]
    actual = hourly_frame({k: [k] * 60 for k in range(9)})
    features, forecasts = (store.KeyedTable.create_or_get(spark, root, s) for s in specs)
    features.upsert(actual)
    forecasts.upsert(actual.withColumnRenamed("rides", "predicted_demand"))
    features.upsert(hourly_frame({3: [5] * 4}, START + timedelta(hours=30)))  # a second folder
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        scored = monitor.errors(features.read_from(START + timedelta(hours=20)), forecasts.read_from(START + timedelta(hours=20)))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert scored.count() == 9 * 40 and scored.agg(F.sum("absolute_error")).first()[0] == 8.0
        merged = features._read_dates(features._state()[1], ["2024-01-02"]).join(forecasts.read().select(*specs[0].keys), list(specs[0].keys), "left_anti")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and merged.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    ranged = features.read_range(START + timedelta(hours=30), START + timedelta(hours=31))
    assert {f.split("event_date=")[1][:10] for f in ranged.inputFiles()} == {"2024-01-02"} and ranged.count() == 18
    assert features.upsert(hourly_frame({k: [k] * 24 for k in range(9)})) == []
    plain = store.KeyedTable.create_or_get(spark, root, store.FEATURES)  # a spec without buckets reads the same rows
    assert plain.read().exceptAll(features.read()).isEmpty() and plain.read().count() == 540


def test_many_batches_are_one_scan(spark, table, hourly_frame):
    for day in range(6):
        table.upsert(hourly_frame({1: [day] * 24}, START + timedelta(days=day)))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert len(folders(table)) == 6 and plan.count("FileScan") == 1 and "Union" not in plan
    assert {r.rides for r in table.read_range(START + timedelta(days=2), START + timedelta(days=3, hours=5)).collect()} == {2, 3}


def test_two_writers_at_once(spark, table, hourly_frame):
    """Each finds the same state; both batches are there, whether or not they touch the same dates."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    table.upsert(hourly_frame({9: [9] * 24}))
    for k, shift in enumerate((24, 3)):  # other dates, then the same date
        barrier = Barrier(2)

        class Slow(store.KeyedTable):
            first = True

            def _merge(self, *args, barrier=barrier):
                done = super()._merge(*args)
                if self.first:
                    self.first = False
                    barrier.wait(60)  # no one switches before both have merged
                return done

        def write(w, k=k, shift=shift):
            Slow(spark, table.path.rsplit("/", 1)[0], store.FEATURES).upsert(
                hourly_frame({10 * (k + 1) + w: [w] * 3}, START + timedelta(days=3 * k + 1, hours=shift * w))
            )

        with ThreadPoolExecutor(2) as pool:
            list(pool.map(write, (0, 1)))
    got = {}
    for (location, _), rides in contents(table.read()).items():
        got.setdefault(location, []).append(rides)
    assert got == {9: [9] * 24, 10: [0] * 3, 11: [1] * 3, 20: [0] * 3, 21: [1] * 3}


def test_repeated_key_within_a_batch(spark, table):
    rows = [(START, 1, v, v % 7) for v in range(50)]
    batch = spark.createDataFrame(rows, "pickup_hour timestamp_ntz, pickup_location_id bigint, rides bigint, run int")
    table.upsert(batch, latest_by="run")
    assert contents(table.read()) == {(1, START): 48}


def test_repeated_keys_must_agree_and_keys_must_be_there(spark, table):
    kind = "pickup_hour timestamp_ntz, pickup_location_id bigint, rides bigint"
    table.upsert(spark.createDataFrame([(START, 1, 5), (START, 1, 5)], kind))
    with pytest.raises(ValueError, match="repeated"):
        table.upsert(spark.createDataFrame([(START, 1, 5), (START, 1, 6)], kind))
    for rows in ([(None, 1, 2)], [(None, 1, 2), (START, 2, 2)], [(START, None, 2)]):
        with pytest.raises(ValueError, match="without"):
            table.upsert(spark.createDataFrame(rows, kind))
    assert contents(table.read()) == {(1, START): 5}


def test_a_stop_before_the_switch_leaves_the_table(spark, table, hourly_frame, monkeypatch):
    first, second = hourly_frame({1: [1] * 48}), hourly_frame({1: [2] * 5, 2: [3] * 30})
    table.upsert(first)

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(store.KeyedTable, "_switch", stop)
        with pytest.raises(OSError):
            table.upsert(second)
    assert contents(table.read()) == contents(first)
    table.upsert(second)
    want = contents(first) | contents(second)
    assert contents(table.read()) == want
    table.vacuum()
    assert contents(table.read()) == want
    with pytest.raises(RuntimeError):  # a second writer of the same state
        table._switch(table._state()[0], {})


def test_range_reads_prune_dates(spark, table, hourly_frame):
    table.upsert(hourly_frame({1: list(range(120))}))
    lo, hi = START + timedelta(hours=30), START + timedelta(hours=50)
    ranged = table.read_range(lo, hi)
    assert sorted(r.rides for r in ranged.collect()) == list(range(30, 51))
    assert {f.split("event_date=")[1][:10] for f in ranged.inputFiles()} == {"2024-01-02", "2024-01-03"}
    assert "GreaterThanOrEqual(pickup_hour" in ranged._jdf.queryExecution().executedPlan().toString()
    assert table.read_from(START + timedelta(hours=100)).count() == 20
    assert table.read(F.col("rides") >= 118).count() == 2
    assert table.read_training(START + timedelta(hours=60), 1).count() == 61
    assert table.create_view("a_view").count() == 120 and spark.table("a_view").count() == 120


def test_key_must_hold_the_event_time(spark):
    bad = store.TableSpec("t", store.HOURLY, ("pickup_location_id",), "pickup_hour")
    with pytest.raises(ValueError):
        store.KeyedTable.create_or_get(spark, scratch_path(spark, "store"), bad)


def test_scratch_is_the_configured_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get(CHECKPOINT_DIR))


def test_macro_and_micro_error(spark):
    rows = [(START, i, float(i == 0) * 10) for i in range(9)] + [(START + timedelta(hours=1), 0, 1.0)]
    actual = spark.createDataFrame([(h, i, 0) for h, i, _ in rows], "pickup_hour timestamp_ntz, pickup_location_id bigint, rides bigint")
    predicted = spark.createDataFrame(rows, "pickup_hour timestamp_ntz, pickup_location_id bigint, predicted_demand double")
    scored = monitor.errors(actual, predicted)
    assert monitor.macro_mae(monitor.mae_by_hour(scored)).first().macro_mae == pytest.approx((10 / 9 + 1) / 2)
    assert monitor.micro_mae(scored).first().micro_mae == pytest.approx(1.1)
    assert monitor.trailing(actual, START + timedelta(hours=1, minutes=30), 1).count() == 10
    assert monitor.trailing(actual, START + timedelta(hours=2), 1).count() == 1


def test_feature_to_dashboard(spark, hourly_frame):
    """Trips on file → features → inference → monitor → dashboard."""
    root, path = scratch_path(spark, "store"), scratch_path(spark, "trips")
    as_of = datetime(2025, 1, 1, 9, 20)
    base = datetime(2025, 1, 1, 10) - timedelta(weeks=52)
    rows = []
    for h in range(1, 29 * 24 + 1):
        pickup = base - timedelta(hours=h) + timedelta(minutes=5)
        for location, per_hour in ((50, 1 + h % 2), (60, 3)):
            rows += [(pickup, pickup + timedelta(minutes=9), 12.0, location, pickup.year, pickup.month)] * per_hour
    trips.write_trips(spark.createDataFrame(rows, TRIPS), path)
    features = jobs.feature_job(spark, path, root, as_of, days=29, rules=TripRules(amount_quantile=1.0))
    assert features.read().agg(F.sum("rides")).first()[0] == len(rows)
    forecasts, skipped = jobs.inference_job(spark, root, as_of, models.FourWeekMean())
    assert skipped.isEmpty()
    got = {r.pickup_location_id: (r.predicted_demand, r.pickup_hour) for r in forecasts.read().collect()}
    assert got[60] == (3.0, datetime(2025, 1, 1, 10)) and set(got) == {50, 60}
    jobs.inference_job(spark, root, as_of, models.FourWeekMean())
    assert forecasts.read().count() == 2

    store.KeyedTable.create_or_get(spark, root, store.FORECASTS).upsert(
        features.read().select("pickup_location_id", (F.col("rides") + 1.0).alias("predicted_demand"), "pickup_hour")
    )
    report = jobs.monitor_job(spark, root, as_of, hours=12)
    assert report["macro"].first().macro_mae == 1.0 and report["micro"].first().micro_mae == 1.0
    assert report["by_hour"].count() == 13

    names = spark.createDataFrame([(50, "Corona"), (60, None)], "pickup_location_id bigint, zone string")
    series = features.read()
    stored = jobs.dashboard_from_store(spark, root, names, as_of)
    assert stored["history"].count() == 2 * 673
    boards = jobs.dashboard_job(forecasts.read(), series, names, as_of, window=24)
    assert [r.zone for r in boards["zones"].collect()] == ["All Zones", "Corona"]
    assert boards["predictions"].count() == 2 and boards["history"].count() == 2 * 25
    assert boards["predictions"].first().pickup_hour == datetime(2025, 1, 1, 5)
    picked = jobs.dashboard_job(forecasts.read(), series, names, as_of, "Corona", 24)
    assert picked["stats"].first().maximum_rides == picked["top"].first().predicted_demand
    with pytest.raises(ValueError):
        jobs.dashboard_job(forecasts.read(), series, names, as_of + timedelta(days=9))


@pytest.mark.parametrize("as_of", [datetime(2024, 2, 1, 9, 20), datetime(2024, 2, 1, 9)])
def test_inference_describes_the_stamped_hour(spark, hourly_frame, as_of):
    """Rides are the hour of the day; one location stopped twenty hours ago, one began too late."""
    root, hour = scratch_path(spark, "store"), datetime(2024, 2, 1, 10)
    n = int((hour - START) / timedelta(hours=1))
    values = {1: [h % 24 for h in range(n)], 2: [h % 24 for h in range(n - 20)]}
    kept = store.KeyedTable.create_or_get(spark, root, store.FEATURES)
    kept.upsert(hourly_frame(values))
    kept.upsert(hourly_frame({3: [1] * 100}, hour - timedelta(hours=100)))
    table, skipped = jobs.inference_job(spark, root, as_of, models.FourWeekMean())
    got = [(r.pickup_location_id, r.predicted_demand, r.pickup_hour) for r in table.read().collect()]
    assert got == [(1, 10.0, hour)]
    left = {r.pickup_location_id: (r.hours, r.last_hour) for r in skipped.collect()}
    assert left == {2: (29 * 24 - 20, hour - timedelta(hours=21)), 3: (100, hour - timedelta(hours=1))}


def test_training_job(spark, hourly_frame):
    root = scratch_path(spark, "store")
    values = {loc: [(i * loc) % 5 for i in range(800)] for loc in (1, 2, 3)}
    store.KeyedTable.create_or_get(spark, root, store.FEATURES).upsert(hourly_frame(values))
    as_of, cutoff = START + timedelta(hours=900), START + timedelta(hours=740)
    version, metrics = jobs.training_job(spark, root, as_of, cutoff, step=12, maxIter=1, maxDepth=2, seed=3)
    assert version == 1 and set(metrics) == {"train_mae", "test_mae"}
    again, same = jobs.training_job(spark, root, as_of, cutoff, step=12, maxIter=1, maxDepth=2, seed=3)
    assert again is None and same["test_mae"] == pytest.approx(metrics["test_mae"])
    with pytest.raises(ValueError):
        jobs.training_job(spark, root, as_of, START + timedelta(hours=5000), step=12, maxIter=1)
    scored = jobs.inference_job(spark, root, START + timedelta(hours=799, minutes=30)).table.read()
    assert scored.count() == 3


def test_history_is_keyed_by_id_not_by_name(spark, hourly_frame):
    predictions = spark.createDataFrame([(56, 5.0, START), (57, 4.0, START)], "pickup_location_id bigint, predicted_demand double, pickup_hour timestamp_ntz")
    names = spark.createDataFrame([(56, "Corona"), (57, "Corona")], "pickup_location_id bigint, zone string")
    shown = dashboard.display_predictions(predictions, names)
    series = hourly_frame({56: [1] * 9, 57: [2] * 9}, START - timedelta(hours=6))  # goes on after the predicted hour
    history = dashboard.top_history(shown, predictions, series, names, 4, 1).collect()
    assert {(r.pickup_location_id, r.zone) for r in history} == {(56, "Corona")} and len(history) == 5
    shown_hours = [START - timedelta(hours=5 + k) for k in range(5)]  # New York time
    assert {(r.datetime, r.rides) for r in history} == {(h, 5.0 if i == 0 else 1.0) for i, h in enumerate(shown_hours)}
    late = hourly_frame({56: [1] * 6}, START - timedelta(hours=9))  # ends three hours before
    assert dashboard.top_history(shown, predictions, late, names, 4, 1).count() == 0
    assert dashboard.pick_zone(shown, "Corona").count() == 2


SCHEMA = "pickup_datetime timestamp_ntz, pickup_location_id bigint"


def write_files(spark, batches):
    """One file per batch, in order, each newer than the one before."""
    path = scratch_path(spark, "incoming")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def test_stream_equals_batch_on_unordered_files(spark, table):
    from demandgrid.operators.series import hourly_counts

    rows = [(START + timedelta(minutes=17 * i), i % 3) for i in range(300)]
    path = write_files(spark, [rows[200:], rows[:100], rows[100:200]])
    schema = spark.read.parquet(path).schema
    stream = hourly.ride_stream(spark, path, schema, files_per_batch=1)
    counts = hourly.hourly_count_stream(stream, "30 days")
    checkpoint = scratch_path(spark, "state")
    hourly.upsert_stream(counts, table, checkpoint).awaitTermination()
    want = contents(hourly_counts(spark.createDataFrame(rows, SCHEMA)))
    assert contents(table.read()) == want
    # Restart on the same checkpoint with one more file: state goes on from where it was.
    spark.createDataFrame(rows[:5], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    hourly.upsert_stream(counts, table, checkpoint).awaitTermination()
    assert contents(table.read()) == contents(hourly_counts(spark.createDataFrame(rows + rows[:5], SCHEMA)))
    out = scratch_path(spark, "updates")
    hourly.write_updates(counts, out, scratch_path(spark, "state")).awaitTermination()
    assert sum(contents(hourly.read_updates(spark, out)).values()) == 305


def test_late_rows_are_dropped(spark):
    early, late = (START + timedelta(minutes=5), 1), (START + timedelta(hours=50), 1)
    path = write_files(spark, [[late], [late], [early]])
    stream = hourly.ride_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    out = scratch_path(spark, "updates")
    hourly.write_updates(hourly.hourly_count_stream(stream, "2 hours"), out, scratch_path(spark, "state")).awaitTermination()
    assert contents(hourly.read_updates(spark, out)) == {(1, START + timedelta(hours=50)): 2}


def test_error_stream(spark):
    a, p = scratch_path(spark, "actual"), scratch_path(spark, "predicted")
    hours = [(START + timedelta(hours=i), 1, i) for i in range(5)]
    spark.createDataFrame(hours, "pickup_hour timestamp_ntz, pickup_location_id bigint, rides bigint").write.parquet(a)
    spark.createDataFrame([(h, i, r + 2.0) for h, i, r in hours[:4]], "pickup_hour timestamp_ntz, pickup_location_id bigint, predicted_demand double").write.parquet(p)
    actual, predicted = (spark.readStream.schema(spark.read.parquet(x).schema).parquet(x) for x in (a, p))
    out = scratch_path(spark, "errors")
    query = (
        hourly.error_stream(actual, predicted)
        .writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    assert [r.absolute_error for r in spark.read.parquet(out).collect()] == [2.0] * 4
