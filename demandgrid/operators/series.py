"""Hourly series: counts per location and hour, gap fill, replay of a past range."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandgrid.functions.times import HOUR, REPLAY_SHIFT, as_datetime, interval, month_of, ntz
from demandgrid.schemas import require_columns

SERIES = "pickup_location_id"
TIME = "pickup_hour"


def hourly_counts(rides: DataFrame) -> DataFrame:
    """Rides per (pickup_hour, pickup_location_id); rows without time or location are not counted.

    Counts are combined before the shuffle, so a location with a third of all rides sends one row per hour and task.
    The hour comes from ``window``, which floors with integer arithmetic inside the generated code.
    """
    require_columns(rides, "pickup_datetime", SERIES)
    return (
        rides.where(F.col(SERIES).isNotNull())
        .select(F.window("pickup_datetime", "1 hour").getField("start").alias(TIME), SERIES)
        .groupBy(TIME, SERIES)
        .agg(F.count("*").alias("rides"))
    )


def fill_hours(
    counts: DataFrame,
    value: str = "rides",
    lo: datetime | None = None,
    hi: datetime | None = None,
    locations: DataFrame | None = None,
) -> DataFrame:
    """Every hour of ``[lo, hi]`` for every location, 0 where nothing was counted.

    Bounds default to the first and last counted hour of the whole table, locations to the counted ones; ``locations``
    (a frame with ``pickup_location_id``) adds silent ones.

    The grid is never shuffled: only the counted rows move (by location), and each of them then emits the empty hours
    up to the next one. The partition number is fixed because rows multiply after this small exchange. The result
    stays partitioned by location, so window functions over a series need no further exchange.
    """
    require_columns(counts, TIME, SERIES, value)
    counts = counts.select(SERIES, TIME, F.col(value).cast("bigint").alias("n"))
    step = interval(HOUR)
    if lo is not None:
        counts = counts.where(F.col(TIME) >= ntz(lo))
    if hi is not None:
        counts = counts.where(F.col(TIME) <= ntz(hi))
    if lo is None or hi is None:
        # One row. Bounds are taken from the counted column as well, which keeps this branch the same shape as the
        # main one: Spark then computes the counts once and reuses the exchange.
        counted = F.when(F.col("n") >= 0, F.col(TIME))
        bounds = counts.agg(
            (F.min(counted) if lo is None else F.first(ntz(lo))).alias("lo"),
            (F.max(counted) if hi is None else F.first(ntz(hi))).alias("hi"),
        )
        bounded = counts.crossJoin(F.broadcast(bounds))
    else:
        bounds = None
        bounded = counts.withColumns({"lo": ntz(lo), "hi": ntz(hi)})

    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = Window.partitionBy(SERIES).orderBy(TIME)
    runs = bounded.repartition(tasks, SERIES).select(
        SERIES,
        TIME,
        "n",
        F.when(F.lag(TIME).over(ordered).isNull(), F.col("lo")).otherwise(F.col(TIME)).alias("start"),
        F.coalesce(F.lead(TIME).over(ordered) - step, F.col("hi")).alias("end"),
    )
    filled = runs.select(SERIES, "n", F.col(TIME).alias("at"), F.explode(F.sequence("start", "end", step)).alias(TIME))
    filled = filled.select(
        TIME, SERIES, F.when(F.col(TIME) == F.col("at"), F.col("n")).otherwise(F.lit(0)).cast("bigint").alias(value)
    )
    if locations is None:
        return filled
    silent = locations.select(SERIES).distinct().join(counts.select(SERIES), SERIES, "left_anti")
    silent = silent.crossJoin(F.broadcast(bounds)) if bounds is not None else silent.withColumns(
        {"lo": ntz(lo), "hi": ntz(hi)}
    )
    zeros = silent.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", step)).alias(TIME), SERIES, F.lit(0).cast("bigint").alias(value)
    )
    return filled.unionByName(zeros)


def pack_hours(
    counts: DataFrame,
    value: str = "rides",
    lo: datetime | None = None,
    hi: datetime | None = None,
    locations: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``fill_hours``, a location a row: the first hour, the number of ``hours`` from there, and of those that were
    counted the place and the value, in order; every other hour is 0.

    A row grows with the counted hours of its location, not with the grid. ``training_windows`` takes it as it is.
    """
    require_columns(counts, TIME, SERIES, value)
    counts = counts.select(SERIES, TIME, F.col(value).cast("bigint").alias("n"))
    if lo is not None:
        counts = counts.where(F.col(TIME) >= ntz(lo))
    if hi is not None:
        counts = counts.where(F.col(TIME) <= ntz(hi))
    counted = F.when(F.col("n") >= 0, F.col(TIME))  # as in fill_hours: the counts are worked out once
    bounds = counts.agg(
        (F.min(counted) if lo is None else F.first(ntz(lo))).alias("lo"), (F.max(counted) if hi is None else F.first(ntz(hi))).alias("hi")
    )
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.timestamp_diff("HOUR", F.col("lo"), F.col(TIME)).cast("int").alias("at")
    listed = F.sort_array(F.collect_list(F.struct("at", "n")))  # at most an entry an hour
    packed = (
        counts.crossJoin(F.broadcast(bounds)).select(SERIES, "lo", "hi", place, "n")
        .repartition(tasks, SERIES).groupBy(SERIES).agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"), listed.alias(value))
    )
    if locations is not None:
        silent = locations.select(SERIES).distinct().join(counts.select(SERIES), SERIES, "left_anti")
        if lo is None or hi is None:
            silent = silent.crossJoin(F.broadcast(bounds))
        else:
            silent = silent.withColumns({"lo": ntz(lo), "hi": ntz(hi)})
        none = F.array().cast(packed.schema[value].dataType)
        packed = packed.unionByName(silent.where(F.col("lo").isNotNull()).withColumn(value, none))
    hours = (F.timestamp_diff("HOUR", F.col("lo"), F.col("hi")) + 1).cast("int")
    return packed.select(SERIES, F.col("lo").alias(TIME), hours.alias("hours"), value)


def hourly_series(rides: DataFrame, packed: bool = False, **bounds) -> DataFrame:
    """Rides to the complete hourly table: count, then fill; ``packed`` gives a row a location instead of a row an hour."""
    return (pack_hours if packed else fill_hours)(hourly_counts(rides), **bounds)


def replay_range(start: datetime | str, end: datetime | str, shift: timedelta = REPLAY_SHIFT) -> tuple[datetime, datetime]:
    start, end = as_datetime(start), as_datetime(end)
    if start >= end:
        raise ValueError("the start must lie before the end")
    return start - shift, end - shift


def replay(rides: DataFrame, start: datetime | str, end: datetime | str, shift: timedelta = REPLAY_SHIFT) -> DataFrame:
    """Rides of the half-open range one ``shift`` earlier, moved forward into ``[start, end)``."""
    lo, hi = replay_range(start, end, shift)
    at = F.col("pickup_datetime")
    return rides.where((at >= ntz(lo)) & (at < ntz(hi))).withColumn("pickup_datetime", at + interval(shift))


def rows_by_month(df: DataFrame, time: str = TIME, first: datetime | None = None, last: datetime | None = None) -> DataFrame:
    """Rows per calendar month, months limited to the closed range ``first`` … ``last``."""
    month = month_of(F.col(time))
    out = df.groupBy(month.alias("year_month")).agg(F.count("*").alias("rows"))
    if first is not None:
        out = out.where(F.col("year_month") >= month_of(ntz(first)))
    if last is not None:
        out = out.where(F.col("year_month") <= month_of(ntz(last)))
    return out
