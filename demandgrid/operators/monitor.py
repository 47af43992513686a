"""Error monitor: actual against predicted rides per location and hour."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.times import clock_floor, ntz
from demandgrid.operators.models import absolute_error
from demandgrid.operators.series import SERIES, TIME


def trailing_start(as_of: datetime, hours: int) -> datetime:
    return clock_floor(as_of - timedelta(hours=hours))


def trailing(df: DataFrame, as_of: datetime, hours: int, time: str = TIME) -> DataFrame:
    """Rows from ``hours`` before ``as_of`` (floored to the hour) on, without upper bound."""
    return df.where(F.col(time) >= ntz(trailing_start(as_of, hours)))


def errors(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Inner join on (location, hour) with the absolute error.

    Both tables hold at most one row per key, so no key is heavy; filter both by time first, the filters reach their
    scans.
    """
    joined = actual.select(SERIES, TIME, "rides").join(
        predicted.select(SERIES, TIME, "predicted_demand"), [SERIES, TIME]
    )
    return joined.withColumn("absolute_error", absolute_error(F.col("rides"), F.col("predicted_demand")))


def mae_by_hour(errors_: DataFrame) -> DataFrame:
    return errors_.groupBy(TIME).agg(F.avg("absolute_error").alias("MAE"))


def macro_mae(by_hour: DataFrame) -> DataFrame:
    """Mean of the hourly means: every hour counts the same."""
    return by_hour.agg(F.avg("MAE").alias("macro_mae"))


def micro_mae(errors_: DataFrame) -> DataFrame:
    """Mean over all rows."""
    return errors_.agg(F.avg("absolute_error").alias("micro_mae"))
