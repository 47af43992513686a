"""Zone dimension: CSV with header in, Parquet out, and the look-up joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.schemas import ZONES, require_columns


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """The text ``N/A`` is a null, as in the published file."""
    return spark.read.csv(path, header=True, schema=ZONES, nullValue="N/A")


def zones_csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str) -> DataFrame:
    read_zones_csv(spark, csv_path).write.mode("overwrite").parquet(parquet_path)
    return spark.read.schema(ZONES).parquet(parquet_path)


def zone_names(zones: DataFrame) -> DataFrame:
    """(pickup_location_id, zone) from the raw dimension; a column already called ``zone`` is accepted."""
    label = "zone" if "zone" in zones.columns else "Zone"
    require_columns(zones, "LocationID", label)
    return zones.select(F.col("LocationID").alias("pickup_location_id"), F.col(label).cast("string").alias("zone"))


def add_zone(facts: DataFrame, names: DataFrame) -> DataFrame:
    """Left look-up: every fact row is kept, an unknown id gets a null zone.

    No broadcast hint: the dimension is a file scan, so Spark knows its size and broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold``; above it both sides are shuffled.
    """
    dim = names.withColumnRenamed("pickup_location_id", "LocationID")
    return facts.join(dim, facts["pickup_location_id"] == dim["LocationID"], "left").drop("LocationID")


def zone_demand(names: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every zone with its predicted demand, 0 where nothing was predicted."""
    demand = predictions.select("pickup_location_id", "predicted_demand")
    return names.join(demand, "pickup_location_id", "left").withColumn(
        "predicted_demand", F.coalesce("predicted_demand", F.lit(0.0))
    )
