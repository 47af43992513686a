from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from demandgrid.operators import features, models, registry, windows
from demandgrid.session import scratch_path

START = datetime(2024, 1, 1)


@pytest.fixture
def small_windows(hourly_frame):
    def build(hours=760, locations=2, step=8):
        values = {loc: [(i % 24) * loc for i in range(hours)] for loc in range(1, locations + 1)}
        return windows.training_windows(hourly_frame(values), "rides", 672, step)

    return build


def test_four_week_mean_skips_missing(spark):
    lags = [None] * 672
    lags[0], lags[168] = 8, 4
    df = spark.createDataFrame([(lags,), ([None] * 672,), ([1, 2, 3],)], "lags array<bigint>")
    got = [r.m for r in df.select(features.four_week_mean().alias("m")).collect()]
    assert got == [6.0, None, None]


def test_named_lag_columns(spark):
    names = ["rides_t-168", "rides_t-336", "rides_t-504", "rides_t-672"]
    df = spark.createDataFrame([(1, 2, 3, 6)], names)
    assert df.select(features.four_week_mean_of_columns(df)).first()[0] == 3.0
    with pytest.raises(ValueError):
        features.four_week_mean_of_columns(df.drop("rides_t-504"))


def test_stages_and_persistence(small_windows):
    w = small_windows()
    out = features.CalendarFeatures(dropKeys=True).transform(features.SeasonalAverage().transform(w))
    assert "pickup_hour" not in out.columns and {"hour", "day_of_week", features.AVERAGE} <= set(out.columns)
    path = scratch_path(w.sparkSession, "stage")
    features.CalendarFeatures(dropKeys=True).save(path)
    assert features.CalendarFeatures.load(path).getOrDefault("dropKeys") is True


def test_feature_vector(small_windows):
    w = small_windows()
    out = features.FeatureVector(inputCols=["target"]).transform(w).first()
    assert list(out.features) == [float(x) for x in out.lags] + [float(out.target)]
    empty = models.feature_pipeline().getStages()[:-1]
    frame = w.limit(0)
    for stage in empty:
        frame = stage.transform(frame)
    assert frame.count() == 0


def test_seasonal_forecast_is_exact_on_a_daily_pattern(small_windows):
    w = small_windows()
    assert models.mae(models.FourWeekMean().transform(w)).first().mae == 0.0
    p = models.predict(models.FourWeekMean(), w, datetime(2024, 3, 1))
    assert p.columns == ["pickup_location_id", "predicted_demand", "pickup_hour"]
    assert {r.pickup_hour for r in p.collect()} == {datetime(2024, 3, 1)}


def test_foreign_model(small_windows):
    w = small_windows()
    scored = models.predict_with_function(w, lambda x: x[:, -24].astype(float))
    got = scored.join(w.select("pickup_location_id", "pickup_hour", "target"), ["pickup_location_id", "pickup_hour"])
    assert got.where(F.col("prediction") != F.col("target")).count() == 0 and got.count() == w.count()
    assert isinstance(np.float64(1.0), float)


def test_train_save_load_promote(small_windows, spark):
    w = small_windows()
    model = models.feature_pipeline(maxIter=2, maxDepth=3, seed=1).fit(w)
    before = model.transform(w).select("pickup_location_id", "pickup_hour", "prediction")
    reg = registry.ModelRegistry(spark, scratch_path(spark, "registry"))
    assert reg.entry("m") is None and reg.metrics("m") is None
    with pytest.raises(LookupError):
        reg.load("m")
    assert reg.register_if_better("m", model, {"test_mae": 2.0}, w) == 1
    assert reg.register_if_better("m", model, {"test_mae": 2.0}, w) is None
    assert reg.register_if_better("m", model, {"test_mae": 1.5}, w) == 2
    assert reg.metrics("m") == {"test_mae": 1.5} and reg.metrics("m", 1) == {"test_mae": 2.0}
    loaded = reg.load("m")
    assert isinstance(loaded, PipelineModel)
    after = loaded.transform(w).select(*before.columns)
    assert before.exceptAll(after).count() == 0
    assert "lags" in reg.entry("m")["input_schema"]


def test_loading_checks_the_inputs(small_windows, spark, hourly_frame):
    w = small_windows()
    reg = registry.ModelRegistry(spark, scratch_path(spark, "registry"))
    reg.register("m", models.feature_pipeline(maxIter=1, maxDepth=1, seed=1).fit(w), {"test_mae": 2.0}, w)
    assert isinstance(reg.load("m", inputs=w.drop("target").withColumn("more", F.lit(1))), PipelineModel)
    assert isinstance(reg.load("m", inputs=w.limit(0)), PipelineModel)  # no window, no length

    def differences(frame):
        with pytest.raises(registry.InputMismatch) as e:
            reg.load("m", inputs=frame)
        return e.value.differences

    n = reg.inputs("m")["lags"].metadata["length"]
    assert registry.describe_inputs(reg.inputs("m")).startswith(f"lags array<bigint>[{n}], ")
    shorter = w.withColumn("lags", F.slice("lags", 2, 10_000))
    assert differences(shorter) == [("lags", "length", str(n), str(n - 1))]
    assert differences(w.withColumn("lags", F.col("lags").cast("array<double>"))) == [("lags", "type", "array<bigint>", "array<double>")]
    assert differences(w.drop("pickup_hour")) == [("pickup_hour", "missing", "timestamp_ntz", None)]


def test_two_jobs_register_at_once(small_windows, spark):
    from concurrent.futures import ThreadPoolExecutor

    w = small_windows()
    root = scratch_path(spark, "registry")
    model = models.feature_pipeline(maxIter=1, maxDepth=1, seed=1).fit(w)
    registry.ModelRegistry(spark, root)
    with ThreadPoolExecutor(3) as pool:
        made = list(pool.map(lambda k: registry.ModelRegistry(spark, root).register("m", model, {"test_mae": float(k)}, w), range(3)))
    assert sorted(made) == [1, 2, 3]
    rows = registry.ModelRegistry(spark, root).table().collect()
    assert {(r.version, r.metrics["test_mae"]) for r in rows} == {(v, float(k)) for k, v in enumerate(made)}
    assert len({r.path for r in rows}) == 3


def test_random_search(small_windows):
    w = small_windows(hours=800, locations=3)
    search = models.random_search(w, {"maxDepth": [1, 2]}, draws=5, folds=2, maxIter=1, lags_only=True)
    report = models.search_report(search, w).collect()
    assert len(report) == 2 and {r.params["maxDepth"] for r in report} == {"1", "2"}
    scored = models.best_pipeline(search, lags_only=True).transform(w)
    assert scored.where("prediction is null").count() == 0
    folds = models.with_folds(w, 3).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == {0, 1, 2}


def test_latest_and_promotions(spark):
    rows = [("a", 1, 3.0), ("a", 2, 4.0), ("a", 3, 2.5), ("a", 4, 2.5), ("b", 1, 9.0)]
    df = spark.createDataFrame(rows, "name string, run int, mae double")
    got = {(r.name, r.run): r.promoted for r in registry.promotions(df).collect()}
    assert got == {("a", 1): True, ("a", 2): False, ("a", 3): True, ("a", 4): False, ("b", 1): True}
    newest = {r.name: r.version for r in registry.latest_versions(df.withColumnRenamed("run", "version")).collect()}
    assert newest == {"a": 4, "b": 1}


def test_run_log(spark):
    path = scratch_path(spark, "runs")
    registry.log_run(spark, path, "exp", "GBT", "mae", 1.25, {"maxDepth": 5})
    registry.log_run(spark, path, "exp", "Mean", "mae", 2.0)
    rows = {r.model: (r.params, r.score) for r in registry.read_runs(spark, path).collect()}
    assert rows == {"GBT": ({"maxDepth": "5"}, 1.25), "Mean": ({}, 2.0)}
