"""Model features as pipeline stages over built-in column functions."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.numbers import row_mean
from demandgrid.functions.times import day_of_week, hour_of_day
from demandgrid.operators.windows import WEEK
from demandgrid.schemas import require_columns

AVERAGE = "average_rides_last_4_weeks"


def lag_at(hours: int, lags: str = "lags") -> Column:
    """The value ``hours`` before the window's hour; null when the window is shorter."""
    return F.get(lags, F.size(lags) - hours)


def four_week_mean(lags: str = "lags") -> Column:
    return row_mean(*[lag_at(WEEK * k, lags) for k in (1, 2, 3, 4)])


def four_week_mean_of_columns(df: DataFrame, feature_col: str = "rides") -> Column:
    """Same, over named lag columns; a missing one is an error."""
    names = [f"{feature_col}_t-{WEEK * k}" for k in (1, 2, 3, 4)]
    require_columns(df, *names)
    return row_mean(*[F.col(f"`{n}`") for n in names])


class SeasonalAverage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the mean of the values 1, 2, 3 and 4 weeks before."""

    @keyword_only
    def __init__(self, *, inputCol: str = "lags", outputCol: str = AVERAGE):
        super().__init__()
        self._setDefault(inputCol="lags", outputCol=AVERAGE)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_columns(dataset, self.getInputCol())
        return dataset.withColumn(self.getOutputCol(), four_week_mean(self.getInputCol()))


class CalendarFeatures(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``hour`` and ``day_of_week`` (Monday 0); with ``dropKeys`` removes the key and time columns."""

    dropKeys = Param(Params._dummy(), "dropKeys", "drop pickup_hour and pickup_location_id", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol: str = "pickup_hour", dropKeys: bool = False):
        super().__init__()
        self._setDefault(inputCol="pickup_hour", dropKeys=False)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        at = F.col(self.getInputCol())
        out = dataset.withColumns({"hour": hour_of_day(at), "day_of_week": day_of_week(at)})
        return out.drop(self.getInputCol(), "pickup_location_id") if self.getOrDefault(self.dropKeys) else out


class FeatureVector(Transformer, HasInputCol, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The lag array followed by the scalar ``inputCols``, as one dense vector, done in the JVM.

    A plain column expression: unlike the stock assembler it neither runs a job to learn the vector's length nor fails
    on an empty frame.
    """

    @keyword_only
    def __init__(self, *, inputCol: str = "lags", inputCols: list[str] | None = None, outputCol: str = "features"):
        super().__init__()
        self._setDefault(inputCol="lags", inputCols=[], outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        require_columns(dataset, self.getInputCol(), *self.getInputCols())
        values = F.col(self.getInputCol()).cast("array<double>")
        if self.getInputCols():
            values = F.concat(values, F.array(*[F.col(c).cast("double") for c in self.getInputCols()]))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(values))
