"""Trip tables: month-partitioned Parquet in, cleaned rides out."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.operators.quality import TripRules, amount_limits, filter_trips
from demandgrid.schemas import TRIPS, require_columns

Months = Iterable[tuple[int, int]]


def months_of_year(year: int, months: Iterable[int] | None = None) -> list[tuple[int, int]]:
    chosen = list(range(1, 13)) if months is None else list(months)
    for m in chosen:
        if not isinstance(year, int) or not isinstance(m, int):
            raise ValueError("year and month must be integers")
        if not 1 <= m <= 12:
            raise ValueError("month must be between 1 and 12")
    return [(year, m) for m in chosen]


def months_between(start: datetime, end: datetime) -> list[tuple[int, int]]:
    """Every (year, month) that the half-open range touches."""
    last = end - timedelta(microseconds=1)
    return [
        (i // 12, i % 12 + 1)
        for i in range(start.year * 12 + start.month - 1, last.year * 12 + last.month)
    ]


def in_months(months: Months) -> Column:
    """Predicate on the partition columns, one term per year, so that unlisted directories are never opened."""
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    if not by_year:
        raise ValueError("no months given")
    terms = [(F.col("year") == y) & F.col("month").isin(ms) for y, ms in by_year.items()]
    predicate = terms[0]
    for term in terms[1:]:
        predicate = predicate | term
    return predicate


def filed_months(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """First and last year that trips are filed under; from the names of files and folders, no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    years = files.agg(F.min("year"), F.max("year")).first()
    return None if years[0] is None else (years[0], years[1])


def read_trips(spark: SparkSession, path: str, months: Months | None = None) -> DataFrame:
    """Trips laid out as ``year=/month=`` directories, with pruned partitions when ``months`` is given."""
    trips = spark.read.schema(TRIPS).parquet(path)
    return trips if months is None else trips.where(in_months(months))


def load_rides(
    spark: SparkSession, path: str, months: Months | None = None, rules: TripRules = TripRules(),
    limits: DataFrame | None = None,
) -> DataFrame:
    """Cleaned rides of one or more months or years. A month without files adds no rows (see ``missing_months``).

    ``limits`` takes the months' ``stored_limits``; without it they are worked out.
    """
    return filter_trips(read_trips(spark, path, months), rules, limits)


LIMITS = "year int, month int, amount_limit double, amount_quantile double"


def stored_limits(
    spark: SparkSession, path: str, limits_path: str, months: Months, rules: TripRules = TripRules()
) -> DataFrame:
    """Amount limits per filing month. Months that have none stored for the quantile of the rules are worked out and added.

    A stored month is taken as closed: when trips are filed into it later, remove its limit. A month without trips gets none.
    """
    months = list(months)
    spark.createDataFrame([], LIMITS).write.mode("ignore").parquet(limits_path)
    kept = spark.read.schema(LIMITS).option("recursiveFileLookup", True)
    stored = kept.parquet(limits_path).where(F.col("amount_quantile") == rules.amount_quantile)
    known = {(r["year"], r["month"]) for r in stored.where(in_months(months)).select("year", "month").collect()}  # calendar months
    missing = [m for m in months if m not in known]
    if missing:
        new = amount_limits(read_trips(spark, path, missing), rules)
        # In a folder of their own: jobs that append to one folder at the same time undo each other's files.
        folder = os.path.join(limits_path, f"rows={uuid.uuid4().hex}")
        new.withColumn("amount_quantile", F.lit(rules.amount_quantile)).coalesce(1).write.parquet(folder)
        stored = kept.parquet(limits_path).where(F.col("amount_quantile") == rules.amount_quantile)
    # Two runs may have added the same month; its limit is the same.
    return stored.where(in_months(months)).groupBy("year", "month").agg(F.max("amount_limit").alias("amount_limit"))


def load_rides_or_fail(spark: SparkSession, path: str, months: Months, rules: TripRules = TripRules()) -> DataFrame:
    """As ``load_rides`` but raises when no ride is left; a job calls it, transforms stay lazy."""
    rides = load_rides(spark, path, months, rules)
    if rides.isEmpty():
        raise ValueError(f"no valid rides for {list(months)}")
    return rides


def missing_months(spark: SparkSession, path: str, months: Months) -> DataFrame:
    """Requested months without a file, instead of skipping them silently.

    Only file names are listed (one row per file, contents are not opened), whatever the number of trips.
    """
    wanted = spark.createDataFrame(list(months), "year int, month int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return wanted.join(files.select("year", "month").distinct(), ["year", "month"], "left_anti")


def write_trips(trips: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lay trips out by filing month. Rebalancing gives each month few files, and splits a month that holds a large
    share of the rows over several tasks."""
    require_columns(trips, *TRIPS.names)
    trips.select(*TRIPS.names).hint("rebalance", "year", "month").write.mode(mode).partitionBy(
        "year", "month"
    ).parquet(path)


def write_rides(rides: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Cleaned rides by month of pickup."""
    require_columns(rides, "pickup_datetime", "pickup_location_id")
    dated = rides.withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
    dated.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month").parquet(path)
