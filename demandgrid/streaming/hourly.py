"""Streaming twins of the hourly count, the keyed write and the error monitor."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from demandgrid.functions.times import EPOCH, HOUR, as_datetime, drop_zone, ntz, utc_instant
from demandgrid.operators.models import absolute_error
from demandgrid.operators.series import SERIES, TIME
from demandgrid.sources.store import KeyedTable


def ride_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def hourly_count_stream(rides: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Rides per hour and location, kept up to date as rides arrive, for output mode ``update`` or ``append``.

    An hour stays open until ``delay`` has passed after it in event time; rides later than that are dropped. State is
    one counter per open hour and location, whatever the number of rides.
    """
    # Watermarks need an instant; a cast would go through the session's zone.
    zoned = rides.where(F.col(SERIES).isNotNull()).select(utc_instant(F.col("pickup_datetime")).alias("at"), SERIES)
    counted = zoned.withWatermark("at", delay).groupBy(F.window("at", "1 hour"), SERIES).agg(F.count("*").alias("rides"))
    return counted.select(drop_zone(F.col("window.start")).alias(TIME), SERIES, "rides")


def write_updates(counts: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Each micro-batch's new or updated rows under ``batch=<id>``; a repeated micro-batch overwrites its own folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        counts.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def read_updates(spark: SparkSession, path: str) -> DataFrame:
    """The newest count per key: counts only grow while an hour is open."""
    return spark.read.parquet(path).groupBy(TIME, SERIES).agg(F.max("rides").alias("rides"))


def upsert_stream(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Keyed sink: every micro-batch is upserted, so replays after a failure leave the table unchanged."""

    def save(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def error_stream(actual: DataFrame, predicted: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Stream–stream inner join of actual and predicted rides per location and hour, with the absolute error.

    Both sides carry a watermark on the hour, which is a join key, so either side's state is dropped once the hour
    has passed.
    """
    left = actual.withColumn(TIME, utc_instant(F.col(TIME))).withWatermark(TIME, delay)
    right = predicted.withColumn(TIME, utc_instant(F.col(TIME))).withWatermark(TIME, delay)
    joined = left.select(SERIES, TIME, "rides").join(right.select(SERIES, TIME, "predicted_demand"), [SERIES, TIME])
    return joined.select(
        SERIES,
        drop_zone(F.col(TIME)).alias(TIME),
        "rides",
        "predicted_demand",
        absolute_error(F.col("rides"), F.col("predicted_demand")).alias("absolute_error"),
    )


# --- complete hours as rides arrive

#: Locations that share a state: so many groups, dealt by a hash of the location. A checkpoint is bound to this number.
BUCKETS = 1024
#: Of each location of a bucket, in order, the first hour that has not been given out; and the open hours with their rides so far.
OPEN_HOURS = "locations array<bigint>, next array<bigint>, at array<bigint>, hours array<bigint>, rides array<bigint>"
#: Rows of one frame that a bucket gives out, at least.
FRAME_ROWS = 500_000
HOUR_MICROS = 3_600_000_000


def _count_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rides per (location, hour) of each Arrow batch, and one row that only carries the time: the start of its newest hour.

    Hours are numbered since the epoch. Counted rows have no time, so none of them is ever taken for late and dropped.
    """
    for batch in batches:
        table = pa.table({"location": batch.column(SERIES).cast(pa.int64()), "at": batch.column("pickup_datetime").cast(pa.timestamp("us")).cast(pa.int64())})
        table = table.filter(pc.is_valid(table["at"]))
        if not len(table):
            continue
        hour = pa.array(table["at"].to_numpy() // HOUR_MICROS)
        counted = table.set_column(1, "hour", hour).filter(pc.is_valid(table["location"])).group_by(["location", "hour"]).aggregate([([], "count_all")])
        clock = pc.max(hour).as_py() * HOUR_MICROS
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([*counted["location"].chunks, pa.nulls(1, pa.int64())]),
                pa.concat_arrays([*counted["hour"].chunks, pa.nulls(1, pa.int64())]),
                pa.concat_arrays([*counted["count_all"].chunks, pa.nulls(1, pa.int64())]),
                pa.array([None] * len(counted) + [clock], pa.int64()),
            ],
            ["location", "hour", "n", "clock"],
        )


def _close_hours(start: int | None, frame_rows: int = FRAME_ROWS, packed: bool = False):
    """State of the locations of a bucket: takes their counts, gives out each hour that the watermark has passed, empty ones too.

    With ``packed`` a counted hour and the empty ones after it are one row, with the number of ``hours``."""
    columns = ["hour", "location", "rides", "late", "hours"] if packed else ["hour", "location", "rides", "late"]

    def summed(location: np.ndarray, hour: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((hour, location))
        location, hour, n = location[order], hour[order], n[order]
        fresh = np.flatnonzero(np.concatenate(([True], (location[1:] != location[:-1]) | (hour[1:] != hour[:-1])))) if len(n) else order
        return location[fresh], hour[fresh], np.add.reduceat(n, fresh) if len(n) else n

    def rows(places: np.ndarray, following: np.ndarray, counts: np.ndarray, spot: np.ndarray, hour: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        begin = np.cumsum(counts) - counts
        hours = np.arange(counts.sum()) + np.repeat(following - begin, counts)
        rides = np.zeros(len(hours), np.int64)
        rides[begin[spot] + hour - following[spot]] = n
        return pd.DataFrame({"hour": hours, "location": np.repeat(places, counts), "rides": rides, "late": False})

    def runs(places: np.ndarray, following: np.ndarray, counts: np.ndarray, spot: np.ndarray, hour: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        # A run begins at each counted hour, and at the first hour of a location.
        empty = counts > 0
        empty[spot[hour == following[spot]]] = False
        lead = np.flatnonzero(empty)
        at, first, n = np.concatenate((spot, lead)), np.concatenate((hour, following[lead])), np.concatenate((n, np.zeros(len(lead), np.int64)))
        order = np.lexsort((first, at))
        at, first, n = at[order], first[order], n[order]
        end = following[at] + counts[at]
        same = at[1:] == at[:-1]
        end[:-1][same] = first[1:][same]
        return pd.DataFrame({"hour": first, "location": places[at], "rides": n, "late": False, "hours": end - first})

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] is None or key[0] != key[0]:
            return  # rows that only carry the time
        known = state.get if state.exists else ([], [], [], [], [])
        places, following, open_place, open_hour, open_n = (np.array(v, np.int64) for v in known)
        came = [[part[c].to_numpy().astype(np.int64) for c in ("location", "hour", "n")] for part in parts if len(part)]
        place, hour, n = summed(*(np.concatenate(v) for v in zip(*came, strict=True))) if came else (np.zeros(0, np.int64),) * 3
        # Sorted by location and hour: the first row of a location has its first hour.
        seen, first = np.unique(place, return_index=True)
        new = ~np.isin(seen, places)
        places = np.concatenate((places, seen[new]))
        following = np.concatenate((following, hour[first[new]] if start is None else np.full(new.sum(), start, np.int64)))
        order = np.argsort(places)
        places, following = places[order], following[order]
        late = hour < following[np.searchsorted(places, place)]
        open_place, open_hour, open_n = summed(
            np.concatenate((open_place, place[~late])), np.concatenate((open_hour, hour[~late])), np.concatenate((open_n, n[~late]))
        )
        watermark = state.getCurrentWatermarkMs()
        closed = watermark // 3_600_000  # hours before this one have ended by the watermark
        counts, begun = np.maximum(closed - following, 0), following
        done = open_hour < closed
        spot, done_hour, done_n = np.searchsorted(places, open_place[done]), open_hour[done], open_n[done]
        following = np.maximum(following, closed)
        state.update(tuple(v.tolist() for v in (places, following, open_place[~done], open_hour[~done], open_n[~done])))
        state.setTimeoutTimestamp(max((int(following.min()) + 1) * 3_600_000 - 1, watermark + 1))
        # Some locations at a time, so that a frame is bounded by what one location gives out.
        given = np.bincount(spot, minlength=len(places)) + (counts > 0) if packed else counts  # rows of a location, at most
        frame = np.cumsum(given) // frame_rows
        for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(frame)) + 1).tolist(), len(places)]):
            if counts[a:b].any():
                lo, hi = np.searchsorted(spot, (a, b))
                yield (runs if packed else rows)(places[a:b], begun[a:b], counts[a:b], spot[lo:hi] - a, done_hour[lo:hi], done_n[lo:hi])[columns]
        if late.any():
            yield pd.DataFrame({"hour": hour[late], "location": place[late], "rides": n[late], "late": True, "hours": 1})[columns]

    return step


def hourly_series_stream(rides: DataFrame, delay: str = "2 hours", start: datetime | None = None, packed: bool = False) -> DataFrame:
    """``pickup_hour, pickup_location_id, rides, late``: the complete hourly table as rides arrive, for output mode ``append``.

    An hour is closed once a ride (of any location) has been seen in an hour that begins ``delay`` or more after its end. Each closed hour comes once for each location, with 0 where nothing was counted: timers wake
    the locations that are silent. A location begins at ``start`` (or at its first hour), so one that is first seen late gets
    its empty hours at once. Rows without a location only move the time on; one of them closes the last hours of a day.

    Nothing is dropped unseen: rides of an hour that has been given out come as rows with ``late`` true, in the micro-batch
    they arrive in; rides before ``start`` are late as well. Counts and late rows together are all rides.

    Rides are combined per hour before the shuffle, so a location with a third of all rides sends a row per hour and Arrow batch.
    With ``packed`` a counted hour and the empty ones after it are one row, ``pickup_hour, pickup_location_id, rides, late, hours``:
    what leaves Python and is written grows with the counted hours, not with the grid. ``unpack_hours`` gives the rows.
    State is one number per open hour and location, and one for each location. Locations are dealt into ``BUCKETS`` by a hash and
    those of a bucket are closed together: a call of Python and a timer cost as much for one location as for hundreds.
    """
    counted = rides.select(F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"), SERIES).mapInArrow(
        _count_batch, "location bigint, hour bigint, n bigint, clock bigint"
    )
    timed = counted.withColumn("clock", F.timestamp_micros("clock")).withWatermark("clock", delay)
    first = None if start is None else int((as_datetime(start) - EPOCH) / HOUR)
    bucket = F.when(F.col("location").isNotNull(), F.pmod(F.xxhash64("location"), F.lit(BUCKETS)).cast("int"))
    # Numbers without nulls: a frame keeps them whole, long ids as well.
    dealt = timed.select(bucket.alias("bucket"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("location", "hour", "n")], "clock")
    closed = dealt.groupBy("bucket").applyInPandasWithState(
        _close_hours(first, packed=packed),
        "hour bigint, location bigint, rides bigint, late boolean" + (", hours bigint" if packed else ""),
        OPEN_HOURS,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    at = ntz(EPOCH) + F.make_dt_interval(F.lit(0), F.col("hour").cast("int"))
    return closed.select(at.alias(TIME), F.col("location").alias(SERIES), "rides", "late", *(["hours"] if packed else []))


def unpack_hours(runs: DataFrame) -> DataFrame:
    """A row for each of the ``hours`` of a run: ``rides`` in the first, 0 in the others."""
    each = runs.select(TIME, SERIES, "rides", "late", F.explode(F.sequence(F.lit(0), F.col("hours").cast("int") - 1)).alias("k"))
    at = F.col(TIME) + F.make_dt_interval(F.lit(0), F.col("k"))
    return each.select(at.alias(TIME), SERIES, F.when(F.col("k") == 0, F.col("rides")).otherwise(F.lit(0)).cast("bigint").alias("rides"), "late")
