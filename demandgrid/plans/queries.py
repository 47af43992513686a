"""One query per operator over the given tables. Keys match ``demandgrid.plans.oracle``."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.functions import times
from demandgrid.operators import dashboard, features, models, monitor, profiles, quality, registry, series, windows
from demandgrid.operators.quantiles import exact_quantiles_of
from demandgrid.plans import inputs, jobs
from demandgrid.session import materialize, scratch_path
from demandgrid.sources import months as months_
from demandgrid.sources import store, trips, zones
from demandgrid.streaming import hourly

NOW = datetime(2024, 1, 30, 21, 30)
REPLAY_NOW = datetime(2025, 1, 27, 9, 20)
TRIPS_NOW = datetime(1999, 1, 11, 9, 20)
QUANTILES = (0.0, 0.01, 0.012, 0.995, 0.999)


# --- sources and quality rules

def scan_trips(spark: SparkSession, sf: str) -> DataFrame:
    t = trips.read_trips(spark, inputs.staged_trips(spark, sf))
    return t.withColumn("duration_seconds", quality.duration_seconds(t))


def _all_months(path: str, spark: SparkSession, around: int = 0) -> list[tuple[int, int]]:
    """Every month of the years that trips are filed under, and of ``around`` years on either side."""
    first, last = trips.filed_months(spark, path)
    return [m for y in range(first - around, last + around + 1) for m in trips.months_of_year(y)]


def load_months(spark: SparkSession, sf: str) -> DataFrame:
    path = inputs.staged_trips(spark, sf)
    cleaned = trips.load_rides(spark, path, _all_months(path, spark), inputs.RULES)
    return cleaned.groupBy(F.year("pickup_datetime").alias("year"), F.month("pickup_datetime").alias("month")).agg(
        F.count("*").alias("rides")
    )


def missing_months(spark: SparkSession, sf: str) -> DataFrame:
    path = inputs.staged_trips(spark, sf)
    return trips.missing_months(spark, path, _all_months(path, spark, around=1))


def month_report(spark: SparkSession, sf: str) -> DataFrame:
    """What became of each month, trips up to 1994 being filed in an older format: other names, zoned times, broken ids."""
    path = scratch_path(spark, "mixed_trips")
    filed = trips.read_trips(spark, inputs.staged_trips(spark, sf))
    old = filed.where(F.col("year") <= 1994).select(
        times.utc_instant(F.col("tpep_pickup_datetime")).alias("Trip_Pickup_DateTime"),
        times.utc_instant(F.col("tpep_dropoff_datetime")).alias("Trip_Dropoff_DateTime"),
        F.col("total_amount").alias("Total_Amt"), F.col("PULocationID").cast("double").alias("pulocationid"), "year", "month",
    )
    for part in (filed.where(F.col("year") > 1994), old):
        part.hint("rebalance", "year", "month").write.mode("append").partitionBy("year", "month").parquet(path)
    loaded = months_.load_rides_by_month(spark, path, _all_months(inputs.staged_trips(spark, sf), spark, around=1), inputs.RULES)
    return loaded.report.select("year", "month", "status", "trips", "rides")


def trip_filter(spark: SparkSession, sf: str) -> DataFrame:
    return quality.filter_trips(trips.read_trips(spark, inputs.staged_trips(spark, sf)), inputs.RULES)


def reject_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.reject_report(trips.read_trips(spark, inputs.staged_trips(spark, sf)), inputs.RULES)


def _zone_file(spark: SparkSession, sf: str) -> DataFrame:
    csv = scratch_path(spark, "zones_csv")
    inputs.zone_rows(spark, sf).write.option("header", True).csv(csv)
    return zones.zones_csv_to_parquet(spark, csv, scratch_path(spark, "zones"))


def zone_dim(spark: SparkSession, sf: str) -> DataFrame:
    return zones.zone_names(_zone_file(spark, sf))


def zone_enrich(spark: SparkSession, sf: str) -> DataFrame:
    return zones.add_zone(series.hourly_counts(inputs.rides(spark, sf)), inputs.user_zones(spark, sf))


def trip_zones(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = quality.filter_trips(trips.read_trips(spark, inputs.staged_trips(spark, sf)), inputs.RULES)
    daily = cleaned.groupBy("pickup_location_id").agg(F.count("*").alias("rides"))
    return zones.add_zone(daily, zones.zone_names(_zone_file(spark, sf)))


# --- profiles

def quantiles(spark: SparkSession, sf: str) -> DataFrame:
    t = trips.read_trips(spark, inputs.staged_trips(spark, sf))
    t = t.select("total_amount", quality.duration_seconds(t).alias("duration_seconds"))
    probs = F.array(*[F.lit(p) for p in QUANTILES])
    found = exact_quantiles_of(t, ["total_amount", "duration_seconds"], QUANTILES)
    rows = found.select("measure", F.inline(F.arrays_zip(probs.alias("p"), F.col("quantiles").alias("q"))))
    return rows.select("measure", F.col("p"), F.round("q", 6).alias("q"))


def describe(spark: SparkSession, sf: str) -> DataFrame:
    row = profiles.describe(inputs.table(spark, sf, "orders"), "o_totalprice")
    return row.select("count", *[F.round(c, 4).alias(c) for c in row.columns[1:]])


def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.column_profile(inputs.table(spark, sf, "orders"))


def histogram(spark: SparkSession, sf: str) -> DataFrame:
    amounts = profiles.histogram(inputs.table(spark, sf, "orders"), "o_totalprice")
    balance = inputs.table(spark, sf, "customer").where(F.col("c_acctbal") < 0)
    both = amounts.withColumn("measure", F.lit("o_totalprice")).unionByName(
        profiles.histogram(balance, "c_acctbal").withColumn("measure", F.lit("negative c_acctbal"))
    )
    return both.select("measure", "bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "rows")


def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    box = profiles.box_stats(inputs.table(spark, sf, "orders"), "o_totalprice")
    rounded = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return box.select(*[F.round(c, 4).alias(c) for c in rounded], "outliers_low", "outliers_high")


def extremes(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.extremes(inputs.table(spark, sf, "events").select("event_id", "ts", "user_id"), ["ts", "event_id"])


# --- hourly series

def hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return series.hourly_counts(inputs.rides(spark, sf))


def gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    return series.hourly_series(inputs.rides(spark, sf))


def _packed_hours(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of ``gap_fill``, a location a row, for windows."""
    return series.hourly_series(inputs.rides(spark, sf), packed=True)


def gap_fill_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed bounds and every customer, silent ones included; zone name attached after the grid."""
    names = inputs.user_zones(spark, sf)
    lo, hi = datetime(2024, 1, 1), datetime(2024, 1, 31, 23)
    return zones.add_zone(series.hourly_series(inputs.rides(spark, sf), lo=lo, hi=hi, locations=names), names)


def time_shift(spark: SparkSession, sf: str) -> DataFrame:
    return series.replay(inputs.rides(spark, sf), "2024-12-30T00:00:00", "2025-01-28T12:30:00")


def rows_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return series.rows_by_month(
        inputs.table(spark, sf, "lineitem"), "l_shipdate", datetime(1992, 1, 1), datetime(2002, 2, 1)
    )


# --- windows

def _summary(w: DataFrame, *extra: Column | str) -> DataFrame:
    """A window as its length, ends, sum and position-weighted sum: changes with any value or order."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)
    return w.select(
        "pickup_location_id",
        "pickup_hour",
        F.size("lags").alias("n_lags"),
        F.get("lags", F.lit(0)).alias("first_lag"),
        F.element_at("lags", -1).alias("last_lag"),
        total(F.col("lags")).alias("lag_sum"),
        total(F.transform("lags", lambda x, i: x * (i + 1))).alias("lag_checksum"),
        *extra,
    )


def _job_windows(spark: SparkSession, sf: str) -> DataFrame:
    return windows.training_windows(_packed_hours(spark, sf), "rides", windows.FOUR_WEEKS, jobs.JOB_STEP)


def window_target(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(_job_windows(spark, sf), "target")


def window_features(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(windows.scoring_windows(_packed_hours(spark, sf), "rides", windows.FOUR_WEEKS, jobs.JOB_STEP))


def window_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(windows.scoring_windows(gap_fill(spark, sf), "rides", windows.FOUR_WEEKS, anchor="end"))


def window_single(spark: SparkSession, sf: str) -> DataFrame:
    """All rides as one series, picked by its name."""
    city = inputs.rides(spark, sf).withColumn("pickup_location_id", F.lit(0).cast("bigint"))
    named = series.hourly_series(city).withColumn("zone", F.lit("City"))
    return windows.single_series_windows(named, None, "rides", 12, 1, location_name="City")


def window_wide(spark: SparkSession, sf: str) -> DataFrame:
    return windows.widen(windows.training_windows(_packed_hours(spark, sf), "rides", 24, 24), 24)


def window_narrow(spark: SparkSession, sf: str) -> DataFrame:
    """Columns and back to the array."""
    return _summary(windows.narrow(window_wide(spark, sf)), "target")


def window_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return windows.unpivot(_job_windows(spark, sf))


def window_padded(spark: SparkSession, sf: str) -> DataFrame:
    """Windows over the counted hours alone: series differ in length, and short ones are padded."""
    counts = series.hourly_counts(inputs.rides(spark, sf))
    return _summary(windows.training_windows(counts, "rides", 64, 5, pad_short=True), "target")


def short_series(spark: SparkSession, sf: str) -> DataFrame:
    return windows.short_series(series.hourly_counts(inputs.rides(spark, sf)), 64)


def backfill(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.backfill(gap_fill(spark, sf))


def seasonal_mean(spark: SparkSession, sf: str) -> DataFrame:
    out = features.SeasonalAverage().transform(_job_windows(spark, sf))
    return out.select("pickup_location_id", "pickup_hour", features.AVERAGE)


def temporal_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.CalendarFeatures().transform(gap_fill(spark, sf))


def time_split(spark: SparkSession, sf: str) -> DataFrame:
    w = windows.training_windows(_packed_hours(spark, sf), "rides", windows.WEEK, jobs.JOB_STEP)
    train, test = windows.split_by_time(w.drop("lags"), datetime(2024, 1, 20))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


# --- clock and text

def tz_display(spark: SparkSession, sf: str) -> DataFrame:
    instant = times.utc_instant(F.col("ts"))
    return inputs.table(spark, sf, "events").select(
        "event_id", times.drop_zone(instant).alias("utc_time"), times.wall_time(F.col("ts")).alias("new_york_time")
    )


def clock_round(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    return inputs.table(spark, sf, "events").select(
        "event_id",
        times.floor_hour(ts).alias("floor_hour"),
        times.ceil_hour(ts).alias("ceil_hour"),
        times.next_hour_of(ts).alias("next_hour"),
    )


def parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as text, every seventh one spoiled."""
    text = F.col("o_orderdate").cast("string")
    spoiled = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("bad "), text)).otherwise(text)
    return inputs.table(spark, sf, "orders").select("o_orderkey", times.parse_time(spoiled).alias("order_time"))


# --- predictions and monitor

def predict(spark: SparkSession, sf: str) -> DataFrame:
    w = windows.scoring_windows(gap_fill(spark, sf), "rides", windows.FOUR_WEEKS, anchor="end")
    return models.predict(models.FourWeekMean(), w, times.next_hour(datetime(2024, 1, 30, 23, 30)))


def _errors(spark: SparkSession, sf: str) -> DataFrame:
    actual = materialize(gap_fill(spark, sf), "hourly")
    recent = [monitor.trailing(df, NOW, windows.FOUR_WEEKS) for df in (actual, jobs.backfill(actual))]
    return monitor.errors(*recent)


def mae_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.mae_by_hour(_errors(spark, sf))


def mae_macro(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.macro_mae(monitor.mae_by_hour(_errors(spark, sf))).select(F.round("macro_mae", 9).alias("macro_mae"))


def mae_overall(spark: SparkSession, sf: str) -> DataFrame:
    scored = models.FourWeekMean().transform(_job_windows(spark, sf))
    return models.mae(scored)


# --- dashboard

def _shown(spark: SparkSession, sf: str) -> DataFrame:
    upcoming = dashboard.next_hour_predictions(backfill(spark, sf), NOW)
    return dashboard.display_predictions(upcoming, inputs.user_zones(spark, sf))


def dashboard_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.pick_zone(_shown(spark, sf))


def dashboard_zone(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.pick_zone(_shown(spark, sf), "NATION_3")


def demand_stats(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.demand_stats(_shown(spark, sf))


def top10(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.top_demand(_shown(spark, sf))


def top10_history(spark: SparkSession, sf: str) -> DataFrame:
    hours, names = materialize(gap_fill(spark, sf), "hourly"), inputs.user_zones(spark, sf)
    upcoming = materialize(dashboard.next_hour_predictions(jobs.backfill(hours), NOW), "upcoming")
    shown = dashboard.display_predictions(upcoming, names)
    return dashboard.top_history(shown, upcoming, hours, names, windows.WEEK)


def dashboard_job(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of the page as (part, name, value)."""
    hours, names = materialize(gap_fill(spark, sf), "hourly"), inputs.user_zones(spark, sf)
    page = jobs.dashboard_job(materialize(jobs.backfill(hours), "predictions"), hours, names, NOW, window=windows.WEEK)
    place = F.col("pickup_location_id").cast("string")
    stats = F.expr("stack(3, 'average', average_rides, 'maximum', maximum_rides, 'minimum', minimum_rides) AS (name, value)")
    parts = {
        "predictions": page["predictions"].agg(F.lit("rows").alias("name"), F.count("*").cast("double").alias("value")),
        "zones": page["zones"].select(F.col("zone").alias("name"), F.col("position").cast("double").alias("value")),
        "stats": page["stats"].select(stats),
        "top": page["top"].select(place.alias("name"), F.col("predicted_demand").alias("value")),
        "history": page["history"].groupBy(place.alias("name")).agg(F.sum("rides").alias("value")),
    }
    out = None
    for part, rows in parts.items():
        rows = rows.select(F.lit(part).alias("part"), "name", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def zone_options(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.zone_options(_shown(spark, sf))


def zone_demand_map(spark: SparkSession, sf: str) -> DataFrame:
    upcoming = dashboard.next_hour_predictions(backfill(spark, sf), NOW)
    return zones.zone_demand(inputs.user_zones(spark, sf), upcoming)


# --- stored tables

def _two_batches(spark: SparkSession, sf: str) -> store.KeyedTable:
    """All hours, then a recount (100 more) of the hours from 15 January on, written twice."""
    counts = series.hourly_counts(inputs.rides(spark, sf))
    recount = counts.where(F.col("pickup_hour") >= times.ntz(datetime(2024, 1, 15))).withColumn(
        "rides", F.col("rides") + 100
    )
    hourly_table = store.KeyedTable.create_or_get(spark, scratch_path(spark, "store"), store.FEATURES)
    for batch in (counts, recount, recount):
        hourly_table.upsert(batch)
    return hourly_table


def upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _two_batches(spark, sf).read()


def store_range(spark: SparkSession, sf: str) -> DataFrame:
    """Closed range read, next to a filtered full read through a view."""
    kept = _two_batches(spark, sf)
    ranged = kept.read_range(datetime(2024, 1, 3, 5), datetime(2024, 1, 27, 17)).withColumn("how", F.lit("range"))
    view = kept.create_view("hourly_rides_view")
    filtered = view.where((F.col("rides") >= 2) & (F.col("pickup_hour") >= F.lit("2024-01-02").cast("timestamp_ntz")))
    return ranged.unionByName(filtered.withColumn("how", F.lit("filter")))


def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "rides")
    trips.write_rides(trip_filter(spark, sf), path)
    return spark.read.parquet(path).select("pickup_datetime", "pickup_location_id", "year", "month")


def matrix_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(materialize(_job_windows(spark, sf), "matrix"), "target")


def feature_job_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job on trips over a year end, with stored limits; the second run reads them."""
    path, root, limits = inputs.staged_trips(spark, sf), scratch_path(spark, "store"), scratch_path(spark, "limits")
    for _ in range(2):
        kept = jobs.feature_job(spark, path, root, TRIPS_NOW, rules=inputs.RULES, limits_path=limits)
    return kept.read()


def feature_job(spark: SparkSession, sf: str) -> DataFrame:
    kept = store.KeyedTable.create_or_get(spark, scratch_path(spark, "store"), store.FEATURES)
    kept.upsert(jobs.feature_rides(inputs.rides(spark, sf), REPLAY_NOW))
    return kept.read()


def dataset_job(spark: SparkSession, sf: str) -> DataFrame:
    """All months of trips to a weekly training matrix."""
    path = inputs.staged_trips(spark, sf)
    out = jobs.dataset_job(
        spark, path, scratch_path(spark, "matrix"), _all_months(path, spark), windows.WEEK, windows.WEEK, inputs.RULES
    )
    return _summary(out, "target")


def _inference(spark: SparkSession, sf: str, thin=lambda hourly: hourly) -> jobs.Inference:
    root = scratch_path(spark, "store")
    kept = store.KeyedTable.create_or_get(spark, root, store.FEATURES)
    kept.upsert(thin(jobs.feature_rides(inputs.rides(spark, sf), REPLAY_NOW, days=29)))
    return jobs.inference_job(spark, root, REPLAY_NOW, models.FourWeekMean())


def _stopped_and_late(hourly: DataFrame) -> DataFrame:
    """A store in which some locations stopped 20 hours ago and some began 100 hours ago."""
    last = times.next_hour(REPLAY_NOW) - times.HOUR
    at, location = F.col("pickup_hour"), F.col("pickup_location_id")
    stopped = (location % 10 == 3) & (at > times.ntz(last - timedelta(hours=20)))
    late = (location % 10 == 7) & (at < times.ntz(last - timedelta(hours=100)))
    return hourly.where(~stopped & ~late)


def inference_job(spark: SparkSession, sf: str) -> DataFrame:
    return _inference(spark, sf).table.read()


def inference_skipped(spark: SparkSession, sf: str) -> DataFrame:
    return _inference(spark, sf, _stopped_and_late).skipped


def monitor_job(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "store")
    actual = materialize(gap_fill(spark, sf), "hourly")
    specs = [replace(t, buckets=8) for t in (store.FEATURES, store.FORECASTS)]
    for spec, rows in zip(specs, (actual, jobs.backfill(actual)), strict=True):
        store.KeyedTable.create_or_get(spark, root, spec).upsert(rows)
    return jobs.monitor_job(spark, root, NOW, 24, *specs)["by_hour"]


# --- registry

def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Error per customer segment and hour, in the role of successive model runs."""
    scored = _errors(spark, sf).join(inputs.segments(spark, sf), "pickup_location_id")
    run = F.timestamp_diff("HOUR", times.ntz(datetime(2024, 1, 1)), F.col("pickup_hour")).cast("int")
    return scored.groupBy("name", run.alias("run")).agg(F.avg("absolute_error").alias("mae"))


def latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return registry.latest_versions(candidates(spark, sf).withColumnRenamed("run", "version"))


def promote(spark: SparkSession, sf: str) -> DataFrame:
    return registry.promotions(candidates(spark, sf))


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    runs = candidates(spark, sf).select(
        F.lit("four_week_mean").alias("experiment"),
        F.col("name").alias("model"),
        F.create_map(F.lit("window"), F.lit("672"), F.lit("run"), F.col("run").cast("string")).alias("params"),
        F.lit("mae").alias("metric"),
        F.col("mae").alias("score"),
    )
    registry.append_runs(runs, path)
    return registry.read_runs(spark, path).select(
        "experiment", "model", F.col("params")["window"].alias("window"), F.col("params")["run"].alias("run"), "metric", "score"
    )


# --- trained models. A tree of one split is the best split of one lag's counts and sums, which SQL can find as well.

CUTOFF = datetime(2024, 1, 24)
STUMP = {"lags_only": True, "maxIter": 1, "maxDepth": 1}


def _six_lags(spark: SparkSession, sf: str) -> DataFrame:
    return windows.training_windows(_packed_hours(spark, sf), "rides", 6, 24)


def train_stump(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the tree of one split on the windows before and from the cutoff."""
    _, report = jobs.fit_and_test(_six_lags(spark, sf), CUTOFF, **STUMP)
    return report.select(*[F.round(c, 9).alias(c) for c in report.columns])


def train_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Error of the tree of one split on all features: four weeks of lags, their weekly mean, hour and day of the week."""
    w = windows.training_windows(_packed_hours(spark, sf), "rides", windows.FOUR_WEEKS, 8)
    _, report = jobs.fit_and_test(w, datetime(2024, 1, 30), maxIter=1, maxDepth=1)
    return report.select(*[F.round(c, 9).alias(c) for c in report.columns])


def train_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out error of three forecasters on weekly windows: trees on all features, deeper trees on lags, mean."""
    w = materialize(windows.training_windows(_packed_hours(spark, sf), "rides", windows.FOUR_WEEKS, 8), "windows")
    cutoff = datetime(2024, 1, 30)
    out = None
    for name, lags_only, params in (
        ("gbt", False, {"maxIter": 3, "seed": 42}),
        ("gbt_lags_depth10", True, {"maxIter": 2, "maxDepth": 10, "seed": 42}),
    ):
        _, report = jobs.fit_and_test(w, cutoff, lags_only, **params)
        row = report.select(F.lit(name).alias("model"), "train_mae", "test_mae")
        out = row if out is None else out.unionByName(row)
    train, test = (models.mae(models.FourWeekMean().transform(p)) for p in windows.split_by_time(w, cutoff))
    mean = train.withColumnRenamed("mae", "train_mae").crossJoin(test.withColumnRenamed("mae", "test_mae"))
    return out.unionByName(mean.select(F.lit("four_week_mean").alias("model"), "train_mae", "test_mae"))


def training_job(spark: SparkSession, sf: str) -> DataFrame:
    """Stored features to a registered model: the registry row, and what the loaded model predicts for all windows."""
    root = scratch_path(spark, "store")
    store.KeyedTable.create_or_get(spark, root, store.FEATURES).upsert(gap_fill(spark, sf))
    for _ in range(2):  # the second run is no better and isn't registered
        jobs.training_job(spark, root, NOW, CUTOFF, window=6, step=24, **STUMP)
    kept = registry.ModelRegistry(spark, root)
    known = store.KeyedTable.create_or_get(spark, root, store.FEATURES).read_training(NOW, 180)
    w = materialize(windows.training_windows(known, "rides", 6, 24, runs=True), "windows")  # checked, then scored
    scored = models.predict(kept.load(jobs.MODEL_NAME, inputs=w), w)
    total = scored.agg(F.count("*").alias("scored"), F.sum("predicted_demand").alias("predicted"))
    metric = lambda m: F.round(F.col("metrics")[m], 9).alias(m)
    inputs_ = F.lit(registry.describe_inputs(kept.inputs(jobs.MODEL_NAME))).alias("inputs")
    return kept.table().select("name", "version", metric("train_mae"), metric("test_mae"), inputs_).crossJoin(F.broadcast(total))  # one row


def random_search(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validated error of each draw, and the held-out error of the best one refitted."""
    train, test = windows.split_by_time(materialize(_six_lags(spark, sf), "windows"), CUTOFF)
    fold = F.pmod(F.dayofyear("pickup_hour") + F.col("pickup_location_id"), F.lit(3))
    search = models.random_search(train, {"minInstancesPerNode": [1, 900]}, draws=2, fold=fold, **STUMP)
    held_out = models.mae(models.best_pipeline(search, lags_only=True).transform(test))
    return (
        models.search_report(search, train)
        .crossJoin(F.broadcast(held_out.withColumnRenamed("mae", "test_mae")))  # one row
        .select(
            F.col("params")["minInstancesPerNode"].cast("int").alias("least"),
            F.round("mae", 9).alias("mae"),
            F.when(F.col("mae") == F.min("mae").over(Window.partitionBy(F.lit(0))), F.round("test_mae", 9)).alias("test_mae"),
        )
    )


# --- streaming

def _file_stream(spark: SparkSession, df: DataFrame, order: str, files: int = 4) -> DataFrame:
    """The rows as a stream of ``files`` files in the order of a time, one file a micro-batch."""
    path = scratch_path(spark, "stream")
    df.repartitionByRange(files, order).write.parquet(path)
    return hourly.ride_stream(spark, path, df.schema, files_per_batch=1)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _file_stream(spark, inputs.rides(spark, sf), "pickup_datetime")


def stream_hourly(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(spark, "updates")
    counts = hourly.hourly_count_stream(_event_stream(spark, sf), "60 days")
    hourly.write_updates(counts, out, scratch_path(spark, "state")).awaitTermination()
    return hourly.read_updates(spark, out)


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    kept = store.KeyedTable.create_or_get(spark, scratch_path(spark, "store"), store.FEATURES)
    counts = hourly.hourly_count_stream(_event_stream(spark, sf), "60 days")
    hourly.upsert_stream(counts, kept, scratch_path(spark, "state")).awaitTermination()
    return kept.read()


def stream_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Actual and predicted rides as two streams, joined across micro-batches."""
    hours = materialize(gap_fill(spark, sf), "hourly")
    predicted = jobs.backfill(hours)
    first = materialize(predicted, "predicted").agg(F.min("pickup_hour").alias("first"))  # one row
    actual = hours.crossJoin(F.broadcast(first)).where(F.col("pickup_hour") >= F.col("first")).drop("first")
    scored = hourly.error_stream(
        _file_stream(spark, actual, "pickup_hour"), _file_stream(spark, predicted, "pickup_location_id"), "60 days"
    )
    out = scratch_path(spark, "errors")
    hourly.write_updates(scored, out, scratch_path(spark, "state"), mode="append").awaitTermination()
    return spark.read.parquet(out).drop("batch")


def _arriving(spark: SparkSession, parts: list[DataFrame], start: datetime) -> DataFrame:
    """The complete hourly table of rides that arrive in parts; the stream is stopped after each and started again. It is stored
    as runs of hours."""
    path, out, state = (scratch_path(spark, n) for n in ("incoming", "hours", "state"))
    for part in parts:
        part.write.mode("append").parquet(path)
        incoming = hourly.ride_stream(spark, path, part.schema)
        hourly.write_updates(hourly.hourly_series_stream(incoming, "2 hours", start, packed=True), out, state, mode="append").awaitTermination()
    return hourly.unpack_hours(spark.read.parquet(out))


def _arrivals(spark: SparkSession, sf: str, late: Column) -> tuple[list[DataFrame], datetime]:
    """The rides in four parts by time, those of ``late`` in the next part, then a row that moves the time past the last hour;
    and the first hour."""
    events = inputs.table(spark, sf, "events").where(F.col("ts").isNotNull())
    week = sum((F.col("ts") >= times.ntz(datetime(2024, 1, d))).cast("int") for d in (8, 16, 23))
    dealt = events.select(
        F.col("ts").alias("pickup_datetime"), F.col("user_id").alias("pickup_location_id"), F.least(F.lit(3), week + late.cast("int")).alias("part")
    )
    ends = dealt.agg(F.min("pickup_datetime").alias("lo"), F.max("pickup_datetime").alias("hi")).first()  # one row
    closing = spark.createDataFrame([(ends["hi"] + timedelta(hours=3), None)], "pickup_datetime timestamp_ntz, pickup_location_id bigint")
    return [dealt.where(F.col("part") == k).drop("part") for k in range(4)] + [closing], times.clock_floor(ends["lo"])


def stream_gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Every hour of every location, given out as it is closed."""
    return _arriving(spark, *_arrivals(spark, sf, F.lit(False))).drop("late")


def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Rides counted in time and rides that came too late, by hour. Every tenth ride arrives a part late; those of
    locations that are not known yet are in time all the same."""
    rows = _arriving(spark, *_arrivals(spark, sf, F.col("event_id") % 10 == 0))
    part = lambda late, name: F.sum(F.when(F.col("late") == late, F.col("rides")).otherwise(0)).alias(name)
    return rows.groupBy("pickup_hour").agg(part(False, "counted"), part(True, "late"))


QUERIES = {
    "q_scan_trips": scan_trips,
    "q_load_months": load_months,
    "q_missing_months": missing_months,
    "q_month_report": month_report,
    "q_zone_dim": zone_dim,
    "q_zone_enrich": zone_enrich,
    "q_trip_zones": trip_zones,
    "q_trip_filter": trip_filter,
    "q_reject_report": reject_report,
    "q_quantiles": quantiles,
    "q_describe": describe,
    "q_profile": column_profile,
    "q_histogram": histogram,
    "q_box_stats": box_stats,
    "q_extremes": extremes,
    "q_hourly_counts": hourly_counts,
    "q_gap_fill": gap_fill,
    "q_gap_fill_zones": gap_fill_zones,
    "q_time_shift": time_shift,
    "q_rows_by_month": rows_by_month,
    "q_window_target": window_target,
    "q_window_features": window_features,
    "q_window_latest": window_latest,
    "q_window_single": window_single,
    "q_window_wide": window_wide,
    "q_window_narrow": window_narrow,
    "q_window_unpivot": window_unpivot,
    "q_window_padded": window_padded,
    "q_short_series": short_series,
    "q_backfill": backfill,
    "q_seasonal_mean": seasonal_mean,
    "q_temporal_features": temporal_features,
    "q_time_split": time_split,
    "q_tz_display": tz_display,
    "q_clock_round": clock_round,
    "q_parse_ts": parse_ts,
    "q_predict": predict,
    "q_mae_by_hour": mae_by_hour,
    "q_mae_macro": mae_macro,
    "q_mae_overall": mae_overall,
    "q_dashboard": dashboard_rows,
    "q_dashboard_zone": dashboard_zone,
    "q_demand_stats": demand_stats,
    "q_top10": top10,
    "q_top10_history": top10_history,
    "q_dashboard_job": dashboard_job,
    "q_zone_options": zone_options,
    "q_zone_demand_map": zone_demand_map,
    "q_upsert": upsert,
    "q_store_range": store_range,
    "q_sink_roundtrip": sink_roundtrip,
    "q_matrix_roundtrip": matrix_roundtrip,
    "q_feature_job": feature_job,
    "q_dataset_job": dataset_job,
    "q_feature_job_trips": feature_job_trips,
    "q_inference_job": inference_job,
    "q_inference_skipped": inference_skipped,
    "q_monitor_job": monitor_job,
    "q_latest_version": latest_version,
    "q_promote": promote,
    "q_run_log": run_log,
    "q_train_stump": train_stump,
    "q_train_calendar": train_calendar,
    "q_train_gbt": train_gbt,
    "q_training_job": training_job,
    "q_random_search": random_search,
    "q_stream_hourly": stream_hourly,
    "q_stream_upsert": stream_upsert,
    "q_stream_errors": stream_errors,
    "q_stream_gap_fill": stream_gap_fill,
    "q_stream_late": stream_late,
}
