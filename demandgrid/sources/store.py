"""Keyed tables: named, versioned, with a primary key and an event time; a repeated key takes the last write.

A table is Parquet by event date. A batch writes new files for the dates it changes and no others, each batch in a folder of
its own, and then a manifest that names the folder of every date. Readers take the newest manifest, so a table changes in
one step: a batch that stops before it leaves the table as it was, and can be run again.

The manifest also keeps the number of rows of each date and a digest of them that does not depend on their order. A batch whose
rows for a date have the same number and digest leaves that date alone, unread and unwritten.

Manifests are numbered, and a number is taken by whoever first gives a complete file that name. A writer that comes second
looks at what the others did: dates that only it has touched are added to their state, the rest of its batch is merged again.

A table whose spec names ``buckets`` keeps the rows of each date in so many files by a hash of the key. Two such tables with the same
keys and number are joined on them without moving a row, and an upsert merges without moving what is stored. For that, Spark
must read files through its catalog; a name for each set of files that is read is put there, for the session.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.times import as_datetime, ntz
from demandgrid.schemas import HOURLY, PREDICTIONS, require_columns
from demandgrid.session import materialize, take_name

DATE = "event_date"
#: So many times a batch is merged again because other writers were first.
ATTEMPTS = 20
State = dict[str, dict]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    event_time: str
    version: int = 1
    description: str = ""
    buckets: int | None = None


FEATURES = TableSpec(
    "hourly_rides", HOURLY, ("pickup_location_id", "pickup_hour"), "pickup_hour", 1, "Rides per location and hour"
)
FORECASTS = TableSpec(
    "hourly_predictions", PREDICTIONS, ("pickup_location_id", "pickup_hour"), "pickup_hour", 1, "Predicted rides"
)


class Overtaken(RuntimeError):
    """Another writer has changed the table in the meantime."""


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.spec = spark, spec
        self.path = os.path.join(root, f"{spec.name}_v{spec.version}")
        self.stored = T.StructType(spec.schema.fields + [T.StructField(DATE, T.DateType())])

    @classmethod
    def create_or_get(cls, spark: SparkSession, root: str, spec: TableSpec) -> "KeyedTable":
        if spec.event_time not in spec.keys:
            raise ValueError("the key must contain the event time, so that a key never changes its partition")
        table = cls(spark, root, spec)
        if not table._manifests():
            try:
                table._switch(0, {})
            except Overtaken:  # it is there now
                pass
        return table

    # --- the manifest: a small JSON file per state, ``{date: {folder, rows, digest}}``; the one with the highest number counts

    def _fs(self):
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, "_manifest"))
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm.org.apache.hadoop.fs.Path

    def _manifests(self) -> list[int]:
        fs, folder, _ = self._fs()
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _read_manifest(self, number: int) -> State:
        fs, folder, path = self._fs()
        stream = fs.open(path(folder, f"{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        # A date of an older table is only its folder.
        return {d: {"folder": v} if isinstance(v, str) else v for d, v in json.loads(text).items()}

    def _state(self) -> tuple[int, State]:
        number = self._manifests()[-1]
        return number, self._read_manifest(number)

    def _switch(self, number: int, dates: State) -> None:
        """Make ``dates`` the state ``number``; raises if another writer was first."""
        fs, folder, path = self._fs()
        hidden, shown = path(folder, f"_{uuid.uuid4().hex}"), path(folder, f"{number:012d}.json")
        stream = fs.create(hidden, False)
        try:
            stream.write(bytearray(json.dumps(dates, sort_keys=True).encode()))
        finally:
            stream.close()
        if not take_name(self.spark, fs, hidden, shown):
            raise Overtaken(f"{self.path} was changed by another writer")

    def _read_dates(self, state: State, dates: Iterable[str]) -> DataFrame:
        """Rows of those dates: one scan, however many batches wrote them. Other dates' files are not listed."""
        paths = {d: os.path.join(self.path, state[d]["folder"], f"{DATE}={d}") for d in sorted(dates)}
        if not paths:
            return self.spark.createDataFrame([], self.stored)
        if self.spec.buckets and all(state[d].get("buckets") == self.spec.buckets for d in paths):
            return self._read_buckets(paths)
        rows = self.spark.read.schema(self.stored).option("basePath", self.path).parquet(*paths.values())
        return rows.select(*self.stored.names)

    def _read_buckets(self, paths: dict[str, str]) -> DataFrame:
        name = f"demandgrid_{hashlib.md5(json.dumps([self.path, paths]).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.stored)
            keys = ", ".join(f"`{k}`" for k in self.spec.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({DATE}) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.spec.buckets} BUCKETS LOCATION '{os.path.join(self.path, '_none')}'"
            )
            parts = " ".join(f"PARTITION ({DATE}='{d}') LOCATION '{p}'" for d, p in paths.items())
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        return self.spark.table(name).select(*self.stored.names)

    def _write(self, rows: DataFrame, path: str) -> None:
        keys = list(self.spec.keys)
        if not self.spec.buckets:
            # Rebalanced by date: few files per date, and a large date split over several tasks. The order is the one the
            # partitioned write needs, extended by the key, so that file statistics narrow reads of one location.
            rows.hint("rebalance", DATE).sortWithinPartitions(DATE, *keys).write.partitionBy(DATE).parquet(path)
            return
        name = f"demandgrid_{uuid.uuid4().hex}"  # only tables of the catalog can be written in buckets
        dealt = rows.repartition(self.spec.buckets, *keys)  # a task a bucket, which leaves one file a date and bucket
        dealt.write.partitionBy(DATE).bucketBy(self.spec.buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name, format="parquet")
        self.spark.sql(f"DROP TABLE {name}")  # an external table: its files stay

    def _files(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Rows of the dates from ``start`` to ``end``."""
        state = self._state()[1]
        return self._read_dates(
            state, [d for d in state if (start is None or d >= start.isoformat()) and (end is None or d <= end.isoformat())]
        )

    def vacuum(self, keep: int = 1) -> None:
        """Delete what only states older than the newest ``keep`` need. Run it when no reader or writer of these is active."""
        numbers = self._manifests()
        fs, folder, path = self._fs()
        used: set[str] = set()
        for number in numbers[-keep:]:
            used |= {v["folder"] for v in self._read_manifest(number).values()}
        for number in numbers[:-keep]:
            fs.delete(path(folder, f"{number:012d}.json"), False)
        for f in fs.listStatus(path(self.path)):
            name = f.getPath().getName()
            if name.startswith("batch=") and name not in used:
                fs.delete(f.getPath(), True)

    def read(self, where: Column | None = None) -> DataFrame:
        """The table, or the rows that meet ``where`` (pushed to the files; add a date condition to prune)."""
        rows = self._files()
        return (rows if where is None else rows.where(where)).select(*self.spec.schema.names)

    def read_range(self, start: datetime, end: datetime) -> DataFrame:
        """Rows with event time in the closed range: whole dates by partition, then exactly."""
        start, end, time = as_datetime(start), as_datetime(end), F.col(self.spec.event_time)
        rows = self._files(start.date(), end.date())
        return rows.where(time.between(ntz(start), ntz(end))).select(*self.spec.schema.names)

    def read_from(self, start: datetime) -> DataFrame:
        start, time = as_datetime(start), F.col(self.spec.event_time)
        return self._files(start.date()).where(time >= ntz(start)).select(*self.spec.schema.names)

    def read_training(self, as_of: datetime, days: int) -> DataFrame:
        """The last 365 + ``days`` days up to ``as_of``."""
        return self.read_range(as_of - timedelta(days=365 + days), as_of)

    def create_view(self, name: str) -> DataFrame:
        self.read().createOrReplaceTempView(name)
        return self.spark.table(name)

    def _digests(self) -> list[Column]:
        """Number of rows and an order-free digest of them, as aggregates."""
        return [
            F.count("*").alias("rows"), F.sum(F.xxhash64(*self.spec.schema.names).cast("decimal(38,0)")).cast("string").alias("digest")
        ]

    def upsert(self, batch: DataFrame, latest_by: str | None = None) -> list[str]:
        """Insert a batch; rows with a key already stored replace it. Running the same batch again changes nothing and writes nothing.
        Gives the dates that were written.

        Within a batch a repeated key keeps the row with the greatest ``latest_by``, found with a combinable aggregate so that
        one key with very many rows is no burden; without ``latest_by`` repeated keys must agree. Null keys are an error.

        The batch is written to the scratch folder once (several steps read it), each changed date once to the table.
        """
        names = self.spec.schema.names
        require_columns(batch, *names, *([latest_by] if latest_by else []))
        keys = list(self.spec.keys)
        typed = batch.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema], *([latest_by] if latest_by else [])
        )
        values = [n for n in names if n not in keys]
        rest = ([latest_by] if latest_by else []) + values
        if len(rest) == 1:
            # A plain maximum is combined in a hash table; the maximum of a struct needs sorted input.
            unique = typed.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0]), (~F.min(rest[0]).eqNullSafe(F.max(rest[0]))).alias("_differ"))
        else:
            unique = typed.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("r"), F.min(F.struct(*rest)).alias("s"))
            unique = unique.select(*keys, *[F.col(f"r.{n}").alias(n) for n in values], (~F.col("r").eqNullSafe(F.col("s"))).alias("_differ"))
        staged = materialize(unique.select(*names, F.to_date(self.spec.event_time).alias(DATE), "_differ"), "batch")

        # One row per calendar date to the driver.
        no_key = F.lit(False)
        for k in keys:
            no_key = no_key | F.col(k).isNull()
        found = staged.groupBy(DATE).agg(F.max(no_key).alias("no_key"), F.max("_differ").alias("differ"), *self._digests()).collect()
        if any(r["no_key"] for r in found):
            raise ValueError(f"rows without {' or '.join(keys)}")
        if latest_by is None and any(r["differ"] for r in found):
            raise ValueError("a key is repeated with different values: say by which column the latest is found")
        staged = staged.drop("_differ")
        digests = {r[DATE].isoformat(): {"rows": r["rows"], "digest": r["digest"]} for r in found}
        number, state = self._state()
        written: State = {}  # what of this batch lies in the table's folder, each merged with the state ``base``
        base = state
        for _ in range(ATTEMPTS):
            # A date that another writer has changed since it was merged is merged again.
            written = {d: v for d, v in written.items() if base.get(d) == state.get(d)}
            todo = self._changed(staged, state, {d: v for d, v in digests.items() if d not in written})
            written |= self._merge(staged, state, todo)
            try:
                if written:
                    self._switch(number + 1, state | written)
                return sorted(written)
            except Overtaken:
                base, (number, state) = state, self._state()
        raise Overtaken(f"{self.path}: other writers were first {ATTEMPTS} times; run the batch again")

    def _changed(self, staged: DataFrame, state: State, digests: State) -> set[str]:
        """Dates on which the batch changes a row. Those with equal digests aren't read; of the others those that are stored are compared."""
        new = {d for d in digests if d not in state}
        unequal = {d for d, v in digests.items() if d in state and any(state[d].get(k) != v[k] for k in v)}
        if not unequal:
            return new
        keys, names = list(self.spec.keys), self.spec.schema.names
        stored = self._read_dates(state, unequal).select(*keys, F.struct(*names).alias("_stored"))
        rows = staged.where(F.col(DATE).isin([date.fromisoformat(d) for d in unequal]))
        differs = ~F.struct(*names).eqNullSafe(F.col("_stored"))
        compared = rows.join(stored, keys, "left").where(differs).select(DATE).distinct()
        return new | {r[DATE].isoformat() for r in compared.collect()}  # calendar dates

    def _merge(self, staged: DataFrame, state: State, dates: set[str]) -> State:
        """Write those dates of the state with the batch's rows put in; gives their part of the manifest."""
        if not dates:
            return {}
        keys = list(self.spec.keys)
        rows = staged.where(F.col(DATE).isin([date.fromisoformat(d) for d in dates]))
        stored = dates & set(state)
        merged = rows
        if stored:
            kept = self._read_dates(state, stored).join(rows.select(*keys), keys, "left_anti")
            merged = kept.select(*rows.columns).unionByName(rows)
        folder = f"batch={uuid.uuid4().hex}"
        path = os.path.join(self.path, folder)
        self._write(merged, path)
        done = self.spark.read.schema(self.stored).parquet(path).groupBy(DATE).agg(*self._digests()).collect()  # calendar dates
        layout = {"folder": folder} | ({"buckets": self.spec.buckets} if self.spec.buckets else {})
        return {r[DATE].isoformat(): layout | {"rows": r["rows"], "digest": r["digest"]} for r in done}
