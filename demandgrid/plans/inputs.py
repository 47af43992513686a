"""The given tables in the roles of trips, rides and zones."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.operators.quality import TripRules
from demandgrid.schemas import TRIPS
from demandgrid.session import scratch_path
from demandgrid.sources.trips import write_trips

# Orders ship within months, not hours: 180 days stands in for the five-hour limit.
RULES = TripRules(max_duration=timedelta(days=180))

_staged: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as rides: time and user."""
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("pickup_datetime"), F.col("user_id").alias("pickup_location_id")
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders as trips: ordered to shipped. Filed under the month two days after the order, so that the
    last two days of a month are strays in the next month's file."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    filed = F.col("o_orderdate") + F.lit(timedelta(days=2))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.year(filed).alias("year"),
        F.month(filed).alias("month"),
    ).select(*TRIPS.names)


def staged_trips(spark: SparkSession, sf_dir: str) -> str:
    """Path of the trips laid out by filing month; written once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        path = scratch_path(spark, "trips")
        write_trips(trips(spark, sf_dir), path)
        _staged[key] = path
    return _staged[key]


def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier ⋈ nation ⋈ region in the shape of the zone file; suppliers in debt have no zone name."""
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("int").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.when(F.col("s_acctbal") < 0, F.lit("N/A")).otherwise(F.col("n_name")).alias("Zone"),
            F.lit("Yellow Zone").alias("service_zone"),
        )
    )


def user_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation as (pickup_location_id, zone) for the events; customers in debt have no zone name."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("pickup_location_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("zone"),
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pickup_location_id"), F.col("c_mktsegment").alias("name")
    )
