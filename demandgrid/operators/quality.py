"""Quality rules for trips, with an amount limit taken per filing month."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.numbers import nan_to_null
from demandgrid.operators.quantiles import exact_quantiles
from demandgrid.schemas import require_columns

# Location ids that stand for "outside the area" or "unknown".
EXCLUDED_LOCATIONS = (1, 264, 265)

RULES = ("duration", "amount", "location", "period")


@dataclass(frozen=True)
class TripRules:
    max_duration: timedelta = timedelta(hours=5)
    amount_quantile: float = 0.999
    excluded_locations: tuple[int, ...] = EXCLUDED_LOCATIONS


def duration(trips: DataFrame) -> Column:
    """As an interval; the rules compare times instead, which is cheaper per row."""
    return trips["tpep_dropoff_datetime"] - trips["tpep_pickup_datetime"]


def duration_seconds(trips: DataFrame) -> Column:
    return F.timestamp_diff("SECOND", trips["tpep_pickup_datetime"], trips["tpep_dropoff_datetime"])


def amount_limits(trips: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Upper limit of the amount per filing month, over all rows of the month and before any rule."""
    limits = exact_quantiles(trips, "total_amount", [rules.amount_quantile], by=["year", "month"])
    return limits.select("year", "month", F.col("quantiles")[0].alias("amount_limit"))


def flag_trips(trips: DataFrame, rules: TripRules = TripRules(), limits: DataFrame | None = None) -> DataFrame:
    """Trips with one boolean per rule (``ok_duration`` …), never null.

    ``limits`` takes stored ``amount_limits`` of the same trips, so that several results need not work them out again.
    A missing time or amount fails its rule; a missing location passes, because only listed ids are excluded.
    """
    require_columns(
        trips, "tpep_pickup_datetime", "tpep_dropoff_datetime", "total_amount", "PULocationID", "year", "month"
    )
    # One row per filing month: bounded by the calendar, so it may be broadcast whatever the size of the trips; a caller's
    # frame is broadcast only if Spark finds it small. It also carries the month's bounds, worked out once per month rather
    # than per trip.
    first = F.try_make_timestamp_ntz("year", "month", F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    following = first + F.make_ym_interval(F.lit(0), F.lit(1))
    own = F.broadcast if limits is None else (lambda df: df)
    limits = amount_limits(trips, rules) if limits is None else limits
    months = own(limits.withColumns({"month_start": first, "month_end": following}))
    flagged = trips.join(months, ["year", "month"], "left")
    amount = nan_to_null(F.col("total_amount"))
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    no, yes = F.lit(False), F.lit(True)
    return flagged.withColumns(
        {
            "ok_duration": F.coalesce((dropoff > pickup) & (dropoff <= pickup + F.lit(rules.max_duration)), no),
            "ok_amount": F.coalesce((amount > 0) & (amount <= F.col("amount_limit")), no),
            "ok_location": F.coalesce(~F.col("PULocationID").isin(*rules.excluded_locations), yes),
            # A month without any amount has no limit row.
            "ok_period": F.coalesce(
                (pickup >= F.coalesce("month_start", first)) & (pickup < F.coalesce("month_end", following)), no
            ),
        }
    )


def all_rules() -> Column:
    return F.col("ok_duration") & F.col("ok_amount") & F.col("ok_location") & F.col("ok_period")


def filter_trips(trips: DataFrame, rules: TripRules = TripRules(), limits: DataFrame | None = None) -> DataFrame:
    """Rides (pickup_datetime, pickup_location_id) of the trips that pass every rule."""
    return (
        flag_trips(trips, rules, limits)
        .where(all_rules())
        .select(
            F.col("tpep_pickup_datetime").alias("pickup_datetime"),
            F.col("PULocationID").alias("pickup_location_id"),
        )
    )


def reject_report(trips: DataFrame, rules: TripRules = TripRules(), limits: DataFrame | None = None) -> DataFrame:
    """Per filing month: total, valid and dropped rows, drop percentage, rejects per rule, negative amounts."""
    valid = F.count_if(all_rules())
    total = F.count("*")
    return (
        flag_trips(trips, rules, limits)
        .groupBy("year", "month")
        .agg(
            total.alias("total_records"),
            valid.alias("valid_records"),
            (total - valid).alias("records_dropped"),
            (F.try_divide((total - valid) * 100.0, total)).alias("percent_dropped"),
            *[F.count_if(~F.col(f"ok_{r}")).alias(f"rejected_{r}") for r in RULES],
            F.count_if(F.col("total_amount") < 0).alias("negative_amounts"),
        )
    )
