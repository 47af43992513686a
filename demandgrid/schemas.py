"""Fixed schemas of the tables, and the column check used at public entry points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


NTZ = T.TimestampNTZType()

# year and month are the partition columns: the month a trip was filed under.
TRIPS = _schema(
    ("tpep_pickup_datetime", NTZ),
    ("tpep_dropoff_datetime", NTZ),
    ("total_amount", T.DoubleType()),
    ("PULocationID", T.IntegerType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
)
RIDES = _schema(("pickup_datetime", NTZ), ("pickup_location_id", T.IntegerType()))
ZONES = _schema(
    ("LocationID", T.IntegerType()),
    ("Borough", T.StringType()),
    ("Zone", T.StringType()),
    ("service_zone", T.StringType()),
)
HOURLY = _schema(("pickup_hour", NTZ), ("pickup_location_id", T.LongType()), ("rides", T.LongType()))
PREDICTIONS = _schema(
    ("pickup_location_id", T.LongType()), ("predicted_demand", T.DoubleType()), ("pickup_hour", NTZ)
)
REGISTRY = _schema(
    ("name", T.StringType()),
    ("version", T.IntegerType()),
    ("path", T.StringType()),
    ("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ("input_schema", T.StringType()),
)
RUNS = _schema(
    ("experiment", T.StringType()),
    ("model", T.StringType()),
    ("params", T.MapType(T.StringType(), T.StringType())),
    ("metric", T.StringType()),
    ("score", T.DoubleType()),
)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
