"""Trips month by month: each month's files by their own schema, and a report of what was read, missing or unreadable.

Footers are read on the executors (schema merging runs as a job for each month, several at a time). Files that agree in their
columns are one scan, whatever the number of months, so only as many scans are planned as there are formats.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.times import drop_zone
from demandgrid.operators.quality import TripRules, all_rules, filter_trips, flag_trips
from demandgrid.schemas import TRIPS
from demandgrid.sources.trips import Months, in_months

#: Other names that columns have had.
OTHER_NAMES: Mapping[str, tuple[str, ...]] = {
    "tpep_pickup_datetime": ("lpep_pickup_datetime", "Trip_Pickup_DateTime", "pickup_datetime"),
    "tpep_dropoff_datetime": ("lpep_dropoff_datetime", "Trip_Dropoff_DateTime", "dropoff_datetime"),
    "total_amount": ("Total_Amt",),
    "PULocationID": ("pu_location_id", "pickup_location_id"),
}
FILED = ("year", "month")
REPORT = "year int, month int, status string, files bigint, detail string"
READ, MISSING, UNREADABLE = "read", "missing", "unreadable"
#: Months whose footers, or rows, are read at the same time.
AT_ONCE = 8


class MonthLoad(NamedTuple):
    """Trips of the months that could be read, and a row for each month asked for."""

    trips: DataFrame
    report: DataFrame


@dataclass
class _Month:
    year: int
    month: int
    status: str = MISSING
    files: int = 0
    folders: list[str] = field(default_factory=list)
    detail: str | None = None
    parts: list[tuple[T.StructType, list[str]]] = field(default_factory=list)  # schema, and what to read by it

    def fail(self, why: str) -> None:
        self.status, self.detail, self.parts = UNREADABLE, why, []


def _reason(error: Exception) -> str:
    """First line of what went wrong, without the path."""
    lines = [x.strip() for x in str(error).splitlines() if re.search(r"\[[A-Z_.]+\]|Exception", x)]
    return re.sub(r"\S*/\S+", "...", (lines or [type(error).__name__])[0])[:200]


def _listed(spark: SparkSession, path: str, months: Months) -> list[_Month]:
    """The months with their folders; file names are listed, contents are not opened."""
    wanted = {(y, m): _Month(y, m) for y, m in months}
    if wanted:
        names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).where(in_months(wanted))
        by_month = names.groupBy(*FILED).agg(
            F.count("*").alias("files"), F.collect_set(F.regexp_replace("path", "/[^/]*$", "")).alias("folders")
        )
        for r in by_month.collect():  # calendar months
            found = wanted[r["year"], r["month"]]
            found.status, found.files, found.folders = READ, r["files"], sorted(r["folders"])
    return [wanted[k] for k in sorted(wanted)]


def _schemas(spark: SparkSession, month: _Month) -> None:
    """Schemas of the month's files: one if they merge, else one for each file."""
    read = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", True).option("recursiveFileLookup", True)
    try:
        try:
            month.parts = [(read.parquet(*month.folders).schema, month.folders)]
        except (PySparkException, Py4JJavaError) as e:
            if "MERGE" not in str(e):
                raise
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(month.folders).select("path")
            month.parts = [(spark.read.parquet(r["path"]).schema, [r["path"]]) for r in files.collect()]  # files of one month
        for schema, _ in month.parts:
            canonical(schema)
    except (PySparkException, Py4JJavaError, ValueError) as e:
        month.fail(_reason(e) if not isinstance(e, ValueError) else str(e))


def canonical(schema: T.StructType, other_names: Mapping[str, tuple[str, ...]] = OTHER_NAMES) -> list[Column]:
    """The columns of a trip from a file's columns: other names, case, whole or broken numbers, times with or without a zone.

    A number that is no whole one of the wanted kind becomes null. Raises ValueError where a column is missing or of another kind.
    """
    there = {f.name.lower(): f for f in schema}
    out = []
    for wanted in TRIPS:
        if wanted.name in FILED:
            continue
        found = next((there[n.lower()] for n in (wanted.name, *other_names.get(wanted.name, ())) if n.lower() in there), None)
        if found is None:
            raise ValueError(f"no column {wanted.name}")
        held, value = found.dataType, F.col(f"`{found.name}`")
        if isinstance(wanted.dataType, T.TimestampNTZType):
            if not isinstance(held, (T.TimestampNTZType, T.TimestampType)):
                raise ValueError(f"column {found.name} is {held.simpleString()}")
            value = drop_zone(value) if isinstance(held, T.TimestampType) else value
        elif not isinstance(held, T.NumericType):
            raise ValueError(f"column {found.name} is {held.simpleString()}")
        else:
            value = value.try_cast(wanted.dataType)
        out.append(value.alias(wanted.name))
    return out


def _read(spark: SparkSession, path: str, schema: T.StructType, places: list[str]) -> DataFrame:
    """Trips of files of one format."""
    filed = [f for f in TRIPS if f.name in FILED]
    whole = T.StructType([f for f in schema if f.name not in FILED] + filed)
    rows = spark.read.schema(whole).option("basePath", path).option("pathGlobFilter", "*.parquet").parquet(*places)
    return rows.select(*canonical(schema), *FILED)


def _verify(spark: SparkSession, path: str, month: _Month) -> None:
    try:
        for schema, places in month.parts:
            _read(spark, path, schema, places).write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError) as e:
        month.fail(_reason(e))


def load_months(spark: SparkSession, path: str, months: Months, verify: bool = False) -> MonthLoad:
    """Trips of the months asked for. A month with an unreadable footer, or without a column that is needed, is left out as a
    whole and reported; the others are read.

    A damaged page shows only when its rows are read: ``verify`` reads the needed columns of each month beforehand, a job a
    month, and leaves damaged months out, too. Without it, such a page fails the job that comes to it.
    """
    found = _listed(spark, path, months)
    there = [m for m in found if m.status == READ]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda m: _schemas(spark, m), there))
        if verify:
            list(pool.map(lambda m: _verify(spark, path, m), [m for m in there if m.status == READ]))
    formats: dict[str, tuple[T.StructType, list[str]]] = {}
    for m in there:
        for schema, places in m.parts:
            formats.setdefault(schema.json(), (schema, []))[1].extend(places)
    trips = spark.createDataFrame([], TRIPS)
    for k, (schema, places) in enumerate(formats.values()):
        rows = _read(spark, path, schema, places)
        trips = rows if k == 0 else trips.unionByName(rows)
    report = [(m.year, m.month, m.status, m.files, m.detail) for m in found]
    return MonthLoad(trips, spark.createDataFrame(report, REPORT))


def load_rides_by_month(
    spark: SparkSession, path: str, months: Months, rules: TripRules = TripRules(), limits: DataFrame | None = None, verify: bool = False
) -> MonthLoad:
    """Cleaned rides of the months that can be read; the report also has their ``trips`` and the ``rides`` that pass the rules."""
    loaded = load_months(spark, path, months, verify)
    counts = flag_trips(loaded.trips, rules, limits).groupBy(*FILED).agg(F.count("*").alias("trips"), F.count_if(all_rules()).alias("rides"))
    counted = F.when(F.col("status") == READ, F.lit(0).cast("bigint"))
    report = loaded.report.join(counts, list(FILED), "left").withColumns({c: F.coalesce(c, counted) for c in ("trips", "rides")})
    return MonthLoad(filter_trips(loaded.trips, rules, limits), report)
