"""Tables behind the next-hour dashboard."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.numbers import floor_at
from demandgrid.functions.times import next_hour, ntz, wall_time
from demandgrid.operators.series import SERIES, TIME
from demandgrid.operators.windows import FOUR_WEEKS, scoring_windows, unpivot
from demandgrid.sources.zones import add_zone

ALL_ZONES = "All Zones"


def next_hour_predictions(predictions: DataFrame, as_of: datetime) -> DataFrame:
    return predictions.where(F.col(TIME) == ntz(next_hour(as_of)))


def display_predictions(predictions: DataFrame, names: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """Demand floored at 0, hour as wall time, zone name attached."""
    shown = predictions.withColumns(
        {"predicted_demand": floor_at(F.col("predicted_demand"), 0.0), TIME: wall_time(F.col(TIME), zone)}
    )
    return add_zone(shown, names)


def pick_zone(shown: DataFrame, zone: str = ALL_ZONES) -> DataFrame:
    return shown if zone == ALL_ZONES else shown.where(F.col("zone") == zone)


def zone_options(shown: DataFrame) -> DataFrame:
    """(position, zone): "All Zones" first, then the distinct names in order. Distinct names are few: the order is
    numbered over them, not over the rows."""
    names = shown.select("zone").where(F.col("zone").isNotNull()).distinct().select(F.lit(1).alias("position"), "zone")
    head = shown.sparkSession.createDataFrame([(0, ALL_ZONES)], "position int, zone string")
    return head.unionByName(names).orderBy("position", "zone")


def demand_stats(shown: DataFrame) -> DataFrame:
    """Average, maximum and minimum (never below 0) of the shown demand."""
    d = "predicted_demand"
    return shown.agg(
        F.avg(d).alias("average_rides"), F.max(d).alias("maximum_rides"), floor_at(F.min(d), 0.0).alias("minimum_rides")
    )


def top_demand(shown: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rows with the greatest demand; ties go to the lower location id."""
    return shown.orderBy(F.desc("predicted_demand"), SERIES, TIME).limit(n)


def top_history(
    shown: DataFrame, upcoming: DataFrame, series: DataFrame, names: DataFrame, window_size: int = FOUR_WEEKS, n: int = 10,
    zone: str = "America/New_York",
) -> DataFrame:
    """The ``window_size`` hours before the predicted hour and the prediction, for the top locations of ``shown``: rows of
    location, zone name, ``window_hour``, ``datetime`` (both in the zone of the page) and rides.

    ``upcoming`` has the predicted hour in UTC, as ``series`` has. Only hours before it count, and a series that doesn't reach it is
    left out. Keyed by location id: names repeat between locations. The top rows are at most ``n``, so they are broadcast, and
    windows are built for their series alone.
    """
    top = top_demand(shown, n).select(SERIES, "predicted_demand")
    top = F.broadcast(top.join(upcoming.select(SERIES, F.col(TIME).alias("hour")), SERIES))
    before = series.join(top.select(SERIES, "hour"), SERIES).where(F.col(TIME) < F.col("hour")).drop("hour")
    latest = scoring_windows(before, "rides", window_size, anchor="end")
    matched = latest.join(top.withColumnRenamed("hour", TIME), [SERIES, TIME])
    rows = unpivot(matched, F.col("predicted_demand"))
    return add_zone(rows.withColumns({c: wall_time(F.col(c), zone) for c in ("window_hour", "datetime")}), names)
