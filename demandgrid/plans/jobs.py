"""End-to-end jobs. Each takes the clock as ``as_of`` and the store root as a path."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.functions.numbers import round_half_even, row_mean
from demandgrid.functions.times import HOUR, as_datetime, clock_floor, next_hour, ntz
from demandgrid.operators import dashboard as boards
from demandgrid.operators.models import feature_pipeline, mae, predict
from demandgrid.operators.monitor import errors, macro_mae, mae_by_hour, micro_mae, trailing_start
from demandgrid.operators.quality import TripRules
from demandgrid.operators.registry import ModelRegistry
from demandgrid.operators.series import SERIES, TIME, hourly_series, replay, replay_range
from demandgrid.operators.windows import (
    FOUR_WEEKS,
    WEEK,
    scoring_windows,
    seasonal_lags,
    split_by_time,
    training_windows,
)
from demandgrid.session import materialize
from demandgrid.sources.store import FEATURES, FORECASTS, KeyedTable, TableSpec
from demandgrid.sources.trips import load_rides, months_between, stored_limits

JOB_STEP = 23
MODEL_NAME = "demand_next_hour"


def feature_rides(
    rides: DataFrame, as_of: datetime, days: int = 28, locations: DataFrame | None = None
) -> DataFrame:
    """The hourly table of the last ``days`` days before the next full hour, replayed from 52 weeks earlier.

    Every hour of that range is there for every counted location, and for those of ``locations``; so writing it again
    replaces each cell, quiet ones included.
    """
    end = next_hour(as_of)
    start = clock_floor(end - timedelta(days=days))
    return hourly_series(replay(rides, start, end), lo=start, hi=end - HOUR, locations=locations)


def feature_job(
    spark: SparkSession, trips_path: str, root: str, as_of: datetime, days: int = 28, rules: TripRules = TripRules(),
    limits_path: str | None = None, locations: DataFrame | None = None,
) -> KeyedTable:
    """Trips of the replayed range → rules → hourly table → keyed store. Only the months in range are read.

    With ``limits_path`` the amount limits of months are worked out once and stored there.
    """
    end = next_hour(as_of)
    months = months_between(*replay_range(end - timedelta(days=days), end))
    limits = stored_limits(spark, trips_path, limits_path, months, rules) if limits_path else None
    rides = load_rides(spark, trips_path, months, rules, limits)
    table = KeyedTable.create_or_get(spark, root, FEATURES)
    table.upsert(feature_rides(rides, as_of, days, locations))
    return table


def dataset_job(
    spark: SparkSession, trips_path: str, out: str, months, window: int = FOUR_WEEKS, step: int = 24,
    rules: TripRules = TripRules(),
) -> DataFrame:
    """Training matrix of the given months, written as Parquet with the lags as one array column.

    Series stay packed up to their windows: years of hours, most of them empty, are not moved or sorted as rows.
    """
    windows = training_windows(hourly_series(load_rides(spark, trips_path, months, rules), packed=True), "rides", window, step)
    windows.write.mode("overwrite").parquet(out)
    return spark.read.schema(windows.schema).parquet(out)


def fit_and_test(windows: DataFrame, cutoff: datetime, lags_only: bool = False, written: bool = False, **params):
    """Fit before ``cutoff``; one row with the error on the training and on the held-out rows.

    The windows are written once, unless they are ``written``: tree fitting scans them repeatedly.
    """
    windows = windows if written else materialize(windows, "windows")
    train, test = split_by_time(windows, cutoff)
    for part, name in ((train, "before"), (test, "from")):
        if part.isEmpty():
            raise ValueError(f"no window {name} {cutoff}: no series is long enough, or the cutoff lies outside")
    model = feature_pipeline(lags_only, **params).fit(train)
    report = mae(model.transform(train)).select(F.col("mae").alias("train_mae")).crossJoin(
        mae(model.transform(test)).select(F.col("mae").alias("test_mae"))
    )
    return model, report


def training_job(
    spark: SparkSession, root: str, as_of: datetime, cutoff: datetime, days: int = 180, window: int = FOUR_WEEKS,
    step: int = JOB_STEP, name: str = MODEL_NAME, **params,
) -> tuple[int | None, dict[str, float]]:
    """Stored features → windows → fit → register when the held-out error is lower than the registered one."""
    series = KeyedTable.create_or_get(spark, root, FEATURES).read_training(as_of, days)
    windows = materialize(training_windows(series, "rides", window, step, runs=True), "windows")  # the registry reads them, too
    model, report = fit_and_test(windows, cutoff, written=True, **params)
    metrics = report.first().asDict()
    return ModelRegistry(spark, root).register_if_better(name, model, metrics, windows), metrics


class Inference(NamedTuple):
    """The table of predictions, and the locations left out with their stored hours and the last of them."""

    table: KeyedTable
    skipped: DataFrame


def inference_job(
    spark: SparkSession, root: str, as_of: datetime, model: Transformer | None = None, window: int = FOUR_WEEKS,
    name: str = MODEL_NAME,
) -> Inference:
    """Stored features of the 29 days before the next full hour → the window that ends there → predictions → keyed store.

    A window describes the hour after its last; only windows of the stamped hour are scored. Locations whose stored hours are
    too few or end earlier get no prediction and are reported. A registered model is loaded only for windows of the kind and
    length it was trained on.
    """
    hour = next_hour(as_of)
    series = KeyedTable.create_or_get(spark, root, FEATURES).read_range(hour - timedelta(days=29), hour - HOUR)
    windows = scoring_windows(series, "rides", window, anchor="end").where(F.col(TIME) == ntz(hour))
    model = model or ModelRegistry(spark, root).load(name, inputs=windows)
    table = KeyedTable.create_or_get(spark, root, FORECASTS)
    table.upsert(predict(model, windows, hour))
    held = series.groupBy(SERIES).agg(F.count("*").alias("hours"), F.max(TIME).alias("last_hour"))
    return Inference(table, held.where((F.col("hours") < window) | (F.col("last_hour") < ntz(hour - HOUR))))


def backfill(series: DataFrame) -> DataFrame:
    """Four-week-mean predictions for every past hour with four weeks of history, in one pass."""
    lagged = seasonal_lags(series).where(F.col("history") >= FOUR_WEEKS)
    mean = row_mean(*[F.col(f"`rides_t-{WEEK * k}`") for k in (1, 2, 3, 4)])
    return lagged.select(SERIES, round_half_even(mean).alias("predicted_demand"), TIME)


def monitor_job(
    spark: SparkSession, root: str, as_of: datetime, hours: int = 12, features: TableSpec = FEATURES, forecasts: TableSpec = FORECASTS
) -> dict[str, DataFrame]:
    """Error tables over the trailing hours; both tables are pruned by date, and joined in place if their specs name as many buckets."""
    start = trailing_start(as_of, hours)
    actual, predicted = (KeyedTable.create_or_get(spark, root, t).read_from(start) for t in (features, forecasts))
    scored = errors(actual, predicted)
    by_hour = mae_by_hour(scored)
    return {"by_hour": by_hour, "macro": macro_mae(by_hour), "micro": micro_mae(scored)}


def dashboard_job(
    predictions: DataFrame, series: DataFrame, names: DataFrame, as_of: datetime, zone: str = boards.ALL_ZONES,
    window: int = FOUR_WEEKS,
) -> dict[str, DataFrame]:
    """Every table of the next-hour page. Raises when nothing was predicted for the hour."""
    upcoming = boards.next_hour_predictions(predictions, as_of)
    if upcoming.isEmpty():
        raise ValueError(f"no predictions for {next_hour(as_of)}")
    shown = boards.display_predictions(upcoming, names)
    picked = boards.pick_zone(shown, zone)
    return {
        "predictions": picked,
        "zones": boards.zone_options(shown),
        "stats": boards.demand_stats(picked),
        "top": boards.top_demand(picked),
        "history": boards.top_history(picked, upcoming, series, names, window),
    }


def dashboard_from_store(
    spark: SparkSession, root: str, names: DataFrame, as_of: datetime, zone: str = boards.ALL_ZONES,
    window: int = FOUR_WEEKS,
) -> dict[str, DataFrame]:
    """``dashboard_job`` on the stored tables; one date of predictions and the last 29 days of features are read."""
    as_of = as_datetime(as_of)
    hour = next_hour(as_of)
    predictions = KeyedTable.create_or_get(spark, root, FORECASTS).read_range(hour, hour)
    series = KeyedTable.create_or_get(spark, root, FEATURES).read_range(hour - timedelta(days=29), hour - HOUR)
    return dashboard_job(predictions, series, names, as_of, zone, window)
