"""Forecasters: boosted trees on window features, the four-week mean, scoring, random search."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.numbers import round_half_even
from demandgrid.functions.times import ntz
from demandgrid.operators.features import AVERAGE, CalendarFeatures, FeatureVector, SeasonalAverage
from demandgrid.session import materialize

TARGET = "target"


def feature_pipeline(lags_only: bool = False, **params) -> Pipeline:
    """Feature stages and a distributed boosted-tree regressor; ``params`` go to ``GBTRegressor``.

    ``lags_only`` trains on the lag values alone.
    """
    tree = GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="prediction", **params)
    if lags_only:
        return Pipeline(stages=[FeatureVector(), tree])
    vector = FeatureVector(inputCols=[AVERAGE, "hour", "day_of_week"])
    return Pipeline(stages=[SeasonalAverage(), CalendarFeatures(), vector, tree])


class FourWeekMean(SeasonalAverage):
    """Forecaster without training: predicts the mean of the same hour in the four weeks before."""

    def __init__(self):
        super().__init__(outputCol="prediction")


def predict(model: Transformer, windows: DataFrame, at: datetime | None = None) -> DataFrame:
    """(pickup_location_id, predicted_demand, pickup_hour); demand rounded half to even.

    ``at`` stamps every row with one hour, otherwise each keeps the hour of its window.
    """
    hour = F.col("pickup_hour") if at is None else ntz(at)
    return model.transform(windows).select(
        "pickup_location_id",
        round_half_even(F.col("prediction").cast("double")).alias("predicted_demand"),
        hour.alias("pickup_hour"),
    )


def predict_with_function(
    windows: DataFrame, function: Callable[[np.ndarray], np.ndarray], columns: Sequence[str] = ("pickup_location_id", "pickup_hour")
) -> DataFrame:
    """Score with a foreign model: ``function`` maps a (rows × lags) matrix to predictions, one Arrow batch at a time."""
    kept = list(columns)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.select(*kept).schema)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                out = batch[kept].copy()
                out["prediction"] = np.asarray(function(np.stack(batch["lags"].to_numpy())), dtype="float64")
                yield out

    return windows.select(*kept, "lags").mapInPandas(score, schema + ", prediction double")


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(predicted - actual)


def mae(scored: DataFrame, actual: str = TARGET, predicted: str = "prediction") -> DataFrame:
    """Mean absolute error of a prediction set, one row."""
    return scored.agg(F.avg(absolute_error(F.col(actual), F.col(predicted))).alias("mae"))


def with_folds(df: DataFrame, folds: int, keys: Sequence[str] = ("pickup_location_id", "pickup_hour")) -> DataFrame:
    """Fold number from a hash of the key: the same on every run and every executor, no shuffle."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int"))


def random_search(
    train: DataFrame,
    grid: Mapping[str, Sequence],
    draws: int = 5,
    folds: int = 3,
    seed: int = 42,
    parallelism: int = 2,
    lags_only: bool = False,
    fold: Column | None = None,
    **params,
) -> CrossValidatorModel:
    """Random draws from ``grid`` (tree parameters by name), cross-validated on MAE; the best is refitted on all rows.

    ``fold`` numbers the folds from 0; by default they come from a hash of the key. Draws are capped by the size of the grid. Features are prepared once; only the tree learner runs per draw and fold.
    """
    stages = feature_pipeline(lags_only, **params).getStages()
    prepared = train
    for stage in stages[:-1]:
        prepared = stage.transform(prepared)
    tree = stages[-1]
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    random.Random(seed).shuffle(points)
    maps = [{tree.getParam(k): v for k, v in point.items()} for point in points[: min(draws, len(points))]]
    search = CrossValidator(
        estimator=tree,
        estimatorParamMaps=maps,
        evaluator=RegressionEvaluator(labelCol=TARGET, predictionCol="prediction", metricName="mae"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    folded = with_folds(prepared, folds) if fold is None else prepared.withColumn("fold", fold.cast("int"))
    rows = folded.select("features", TARGET, "fold")
    return search.fit(materialize(rows, "folds"))  # read once per draw and fold


def best_pipeline(search: CrossValidatorModel, lags_only: bool = False) -> PipelineModel:
    """The feature stages with the refitted tree, ready for ``predict``."""
    return PipelineModel(feature_pipeline(lags_only).getStages()[:-1] + [search.bestModel])


def search_report(search: CrossValidatorModel, train: DataFrame) -> DataFrame:
    """Draw, parameters and cross-validated MAE: one row per draw."""
    rows = [
        (i, {p.name: str(v) for p, v in point.items()}, float(score))
        for i, (point, score) in enumerate(zip(search.getEstimatorParamMaps(), search.avgMetrics))
    ]
    return train.sparkSession.createDataFrame(rows, "draw int, params map<string,string>, mae double")


