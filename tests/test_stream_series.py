"""The complete hourly table as a stream: gap fill by timers, late rows kept."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from demandgrid.operators.series import hourly_series
from demandgrid.session import scratch_path
from demandgrid.streaming import hourly

START = datetime(2024, 1, 1)
SCHEMA = "pickup_datetime timestamp_ntz, pickup_location_id bigint"


class Feed:
    """A folder of files that arrive one by one, and the stream over it."""

    def __init__(self, spark, delay="2 hours", start=START):
        self.spark, self.out, self.state, self.path = spark, *(scratch_path(spark, n) for n in ("out", "state", "incoming"))
        self.make = lambda: hourly.hourly_series_stream(
            hourly.ride_stream(spark, self.path, spark.read.parquet(self.path).schema, files_per_batch=1), delay, start
        )

    def arrive(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return self

    def run(self):
        hourly.write_updates(self.make(), self.out, self.state, mode="append").awaitTermination()
        return self

    def rows(self):
        return [(r.pickup_hour, r.pickup_location_id, r.rides, r.late) for r in self.spark.read.parquet(self.out).drop("batch").collect()]


def rides(seed, n, hours=60, locations=4):
    r = random.Random(seed)
    return sorted((START + timedelta(minutes=r.randrange(hours * 60)), r.randrange(locations)) for _ in range(n))


def filled(spark, rows):
    return sorted((r.pickup_hour, r.pickup_location_id, r.rides, False) for r in hourly_series(spark.createDataFrame(rows, SCHEMA), lo=START).collect())


def flush(rows, hours=3):
    last = max(t for t, _ in rows if t).replace(minute=0)
    return [(last + timedelta(hours=hours), None)]


def test_equals_the_batch_and_survives_a_restart(spark):
    rows = rides(1, 150)
    rows = [r for r in rows if r[1] != 3 or r[0] > START + timedelta(hours=40)]  # one location begins late
    rows += [(START, 0), (None, 1)]
    rows.sort(key=lambda r: r[0] or START)
    parts = [rows[:50], rows[50:90], rows[90:], flush(rows)]
    whole, halted = Feed(spark), Feed(spark)
    for p in parts:
        whole.arrive(p)
    whole.run()
    for p in parts:
        halted.arrive(p).run()
    want = filled(spark, [r for r in rows if r[0]])
    assert sorted(whole.rows()) == want
    assert sorted(halted.rows()) == want
    halted.run()  # nothing new arrives
    assert sorted(halted.rows()) == want


def test_timers_wake_silent_locations(spark):
    feed = Feed(spark).arrive([(START, 1), (START, 2)]).run()
    feed.arrive([(START + timedelta(hours=10, minutes=30), 2)]).run()
    got = sorted(feed.rows())
    hours = [START + timedelta(hours=h) for h in range(8)]  # 10:00 less two hours: hours before 8:00 are closed
    assert got == sorted((h, p, int(h == START), False) for h in hours for p in (1, 2))


def test_late_rows_are_kept_apart(spark):
    rows, late = rides(2, 120, 48), [(START + timedelta(hours=1, minutes=5), 1), (START + timedelta(hours=1, minutes=9), 1), (START - timedelta(hours=5), 2)]
    feed = Feed(spark).arrive(rows).run().arrive(late).run().arrive(flush(rows)).run()
    got = feed.rows()
    assert sorted(r for r in got if not r[3]) == filled(spark, rows)
    assert sorted(r for r in got if r[3]) == [(START - timedelta(hours=5), 2, 1, True), (START + timedelta(hours=1), 1, 2, True)]
    assert sum(r[2] for r in got) == len(rows) + len(late)


def test_open_hours_wait_for_the_delay(spark):
    first = [(START + timedelta(hours=h), 1) for h in (0, 5)]
    feed = Feed(spark, "3 hours").arrive(first).run()
    assert max(r[0] for r in feed.rows()) == START + timedelta(hours=1)
    feed.arrive([(START + timedelta(hours=2, minutes=5), 1)]).run().arrive(flush(first, 4)).run()
    got = {r[0]: r[2:] for r in feed.rows()}
    assert got[START + timedelta(hours=2)] == (1, False) and len(got) == 6 and not any(late for _, late in got.values())


def test_without_a_start_series_begin_with_their_first_hour(spark):
    rows = [(START + timedelta(hours=2), 1), (START + timedelta(hours=4), 2)]
    feed = Feed(spark, start=None).arrive(rows).run().arrive(flush(rows)).run()
    first = {}
    for hour, location, *_ in sorted(feed.rows(), key=lambda r: r[0]):
        first.setdefault(location, hour)
    assert first == {1: START + timedelta(hours=2), 2: START + timedelta(hours=4)}


def test_a_hot_location_is_combined_before_the_shuffle():
    import pyarrow as pa

    at = pa.array([START + timedelta(seconds=i % 7200) for i in range(5000)], pa.timestamp("us"))
    batch = pa.RecordBatch.from_arrays([at, pa.array([7] * 5000)], ["pickup_datetime", "pickup_location_id"])
    out = pa.Table.from_batches(list(hourly._count_batch([batch])))
    assert sorted(out["n"].to_pylist()[:2]) == [1400, 3600] and len(out) == 3
    assert out["clock"].null_count == 2
