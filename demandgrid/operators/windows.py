"""Sliding lag windows over ordered series.

A window is one row: ``lags`` (array, oldest first), ``pickup_hour`` (time of the value after the window) and, for
training, ``target`` (that value). Input must be gap-filled: windows count rows, in hour order.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.times import HOUR, interval, ntz
from demandgrid.operators.series import SERIES, TIME
from demandgrid.schemas import require_columns
from demandgrid.session import materialize

WEEK = 24 * 7
FOUR_WEEKS = 4 * WEEK


def _number_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with ``pos``, the place in their series within this partition, and ``part``, the partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        runs = pc.run_end_encode(batch.column(SERIES))
        ends, values = runs.run_ends.to_numpy().astype(np.int64), runs.values
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        if len(ends) and (values[0].as_py(),) == last:
            starts[0] -= seen
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.arange(batch.num_rows) - np.repeat(starts, np.diff(ends, prepend=0))), pa.array(np.full(batch.num_rows, part, np.int32))],
            [*batch.schema.names, "pos", "part"],
        )
        if len(ends):
            last, seen = (values[len(values) - 1].as_py(),), int(ends[-1] - starts[-1])


def _numbered_across_tasks(rows: DataFrame) -> DataFrame:
    """Rows with their place ``pos`` in their series, in hour order, however many tasks a series spans.

    Rows are laid out in ranges of (series, hour) and numbered within each range. A range can only continue the one series
    that began before it, so the rows of that series in earlier ranges are one number a range.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = T.StructType([*rows.schema.fields, T.StructField("pos", T.LongType()), T.StructField("part", T.IntegerType())])
    laid = rows.repartitionByRange(parts, SERIES, TIME).sortWithinPartitions(SERIES, TIME).mapInArrow(_number_partition, kinds)
    laid = materialize(laid, "ranges")  # ranges are cut by a sample: they must not be cut again
    totals = laid.groupBy(SERIES, "part").agg((F.max("pos") + 1).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(SERIES).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    earlier = totals.select(F.col(SERIES).alias("_series"), F.col("part").alias("_part"), earlier.alias("earlier")).where("earlier > 0")
    same = F.col(SERIES).eqNullSafe(F.col("_series")) & (F.col("part") == F.col("_part"))
    numbered = laid.join(F.broadcast(earlier), same, "left")  # at most a row a range
    return numbered.select(*rows.columns, (F.col("pos") + F.coalesce("earlier", F.lit(0))).alias("pos"))


def _sliding(df: DataFrame, value: str, window: int, step: int, chunk: int | None, spread: bool = False) -> DataFrame:
    """(series, lags, target, time) for window starts 0, step, 2·step … of each series.

    Series are cut into chunks of ``chunk`` window starts; a row joins each chunk whose windows reach it (one, or two
    near a border). An array therefore never holds more than ``chunk + window`` values however long a series is, and
    the chunks of one series need no exchange beyond the one by series that numbers its rows. The default of three
    windows repeats a third of the rows.

    With ``spread`` a series is numbered in ranges and its chunks are dealt to tasks in ranges as well.
    """
    if window < 1 or step < 1:
        raise ValueError("window and step must be positive")
    chunk = chunk or max(3 * window, 1000)
    span = max(chunk // step, 1) * step
    rows = df.select(SERIES, TIME, F.col(value).alias("v"))
    if spread:
        numbered = _numbered_across_tasks(rows)
    else:
        ordered = Window.partitionBy(SERIES).orderBy(TIME)
        numbered = rows.withColumn("pos", F.row_number().over(ordered) - 1)
    first = F.greatest(F.lit(0), F.expr(f"(pos - {window} + {step} - 1) div {span}"))
    reach = numbered.withColumns({"first": first, "last": F.expr(f"pos div {span}")})
    # With a step beyond the window, rows between two windows belong to no chunk.
    chunked = reach.where(F.col("first") <= F.col("last")).select(
        SERIES, TIME, "v", "pos", F.explode(F.sequence("first", "last")).alias("chunk")
    )
    if spread:
        chunked = chunked.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), SERIES, "chunk")
    starts = (
        chunked.groupBy(SERIES, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("pos", TIME, "v"))).alias("rows"))
        .where(F.size("rows") > window)
        .select(
            SERIES,
            "rows",
            # Guarded as well as filtered: sequence raises on a negative end.
            F.explode(F.sequence(F.lit(0), F.greatest(F.size("rows") - window - 1, F.lit(0)), F.lit(step))).alias("i"),
        )
    )
    # Slice first, then pick the field: taking the field of the whole array would be repeated for every window.
    after = F.get("rows", F.col("i") + window)
    return starts.select(
        F.slice("rows", F.col("i") + 1, window).getField("v").alias("lags"),
        after.getField("v").alias("target"),
        SERIES,
        after.getField(TIME).alias(TIME),
    )


#: Values in the lags of one Arrow batch, at least.
BATCH_VALUES = 500_000
HOUR_MICROS = 3_600_000_000
#: In the place of a missing hour: before all others, as in Spark's order.
UNKNOWN = -(2**63)


def _unpacked_windows(value: str, window: int, step: int):
    """Windows of series that are a row each. A run of windows is laid out at a time, so a long series is never whole in memory."""
    most = max(BATCH_VALUES // max(window, step), 1)

    def made(held: list[tuple], batch: pa.RecordBatch, kinds: pa.Schema) -> pa.RecordBatch:
        rows, first, lags, target = (list(c) for c in zip(*held, strict=True))
        lags, sizes = np.concatenate(lags), [len(f) for f in first]
        ends = np.arange(len(lags) + 1, dtype=np.int32) * window
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(lags.reshape(-1))),
                pa.array(np.concatenate(target)),
                batch.column(SERIES).take(pa.array(np.repeat(rows, sizes))),
                pa.array(np.concatenate(first)).cast(kinds.field(TIME).type),
            ],
            ["lags", "target", SERIES, TIME],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, hours = batch.column(TIME).cast(pa.int64()).to_numpy(), batch.column("hours").to_numpy()
            listed = batch.column(value)
            entries, ends = listed.flatten(), np.concatenate(([0], np.cumsum(pc.list_value_length(listed).to_numpy())))
            places, counts = (entries.field(i).to_numpy() for i in (0, 1))
            held: list[tuple] = []
            size = 0
            for row in range(batch.num_rows):
                at, n = places[ends[row] : ends[row + 1]], counts[ends[row] : ends[row + 1]]
                for i in range(0, max(0, hours[row] - window), most * step):
                    m = min(most, -(-(hours[row] - window - i) // step))
                    cells = np.zeros((m - 1) * step + window + 1, np.int64)
                    a, b = np.searchsorted(at, (i, i + len(cells)))
                    cells[at[a:b] - i] = n[a:b]
                    lags = np.lib.stride_tricks.sliding_window_view(cells, window)[: (m - 1) * step + 1 : step]
                    time = begin[row] + (i + window + step * np.arange(m, dtype=np.int64)) * HOUR_MICROS
                    held.append((row, time, lags, cells[window::step]))
                    size += lags.size
                    if size >= BATCH_VALUES:
                        yield made(held, batch, batch.schema)
                        held, size = [], 0
            if held:
                yield made(held, batch, batch.schema)

    return run


#: Rows of a run, at most.
RUN = WEEK


def _runs_of_rows():
    """Rows that follow each other by the hour in one series, as they come: the series, the first hour and the values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(SERIES).dictionary_encode(null_encoding="encode").indices.to_numpy()
            time = batch.column(TIME)
            at, known = time.cast(pa.int64()).fill_null(0).to_numpy(), time.is_valid().to_numpy(zero_copy_only=False)
            goes_on = (place[1:] == place[:-1]) & (at[1:] == at[:-1] + HOUR_MICROS) & known[1:] & known[:-1]
            begun = np.flatnonzero(np.concatenate(([True], ~goes_on)))
            inside = np.arange(batch.num_rows) - np.repeat(begun, np.diff(np.append(begun, batch.num_rows)))
            begun = np.flatnonzero(inside % RUN == 0)
            first = pa.array(begun)
            values = pa.ListArray.from_arrays(pa.array(np.append(begun, batch.num_rows).astype(np.int32)), batch.column("v"))
            yield pa.RecordBatch.from_arrays([batch.column(SERIES).take(first), time.take(first), values], [SERIES, TIME, "v"])

    return run


def _windows_of_runs(window: int, step: int):
    """Windows of runs that are sorted by series and hour. The rows of one series, 16 bytes each, are held until it ends."""
    most = max(BATCH_VALUES // window, 1)

    def cut(place: pa.Array, at: np.ndarray, values: pa.Array, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        code = place.dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = np.lexsort((at, code))  # runs may overlap
        begun = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        n = np.diff(np.append(begun, len(code)))
        m = np.where(n > window, (n - window - 1) // step + 1, 0)
        starts = np.repeat(begun, m) + step * (np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m))
        for i in range(0, len(starts), most):
            rows = starts[i : i + most]
            after = order[rows + window]
            lags = values.take(pa.array(order[(rows[:, None] + np.arange(window)).reshape(-1)]))
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * window)
            time = pa.array(at[after], mask=at[after] == UNKNOWN).cast(kind)
            columns = [pa.ListArray.from_arrays(ends, lags), values.take(pa.array(after)), place.take(pa.array(after)), time]
            yield pa.RecordBatch.from_arrays(columns, ["lags", "target", SERIES, TIME])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field(TIME).type
            sizes = pc.list_value_length(batch.column("v")).to_numpy()
            first = batch.column(TIME).cast(pa.int64()).fill_null(UNKNOWN).to_numpy()
            inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            at = np.repeat(first, sizes) + inside * HOUR_MICROS
            place, values = batch.column(SERIES).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))), batch.column("v").flatten()
            if held is not None:
                place, at, values = pa.concat_arrays([held[0], place]), np.concatenate((held[1], at)), pa.concat_arrays([held[2], values])
            code = place.dictionary_encode(null_encoding="encode").indices.to_numpy()
            last = int(np.searchsorted(code, code[-1]))  # sorted by series: codes rise
            if last:
                yield from cut(place[:last], at[:last], values[:last], kind)
            held = place[last:], at[last:], values[last:]
        if held is not None:
            yield from cut(*held, kind)

    return run


def _sliding_runs(df: DataFrame, value: str, window: int, step: int) -> DataFrame:
    """``_sliding`` for rows that lie in hour order by location for stretches, as keyed tables keep them: a stretch moves as one row.
    In any other order a row is a stretch; the windows are the same."""
    if window < 1 or step < 1:
        raise ValueError("window and step must be positive")
    rows = df.select(SERIES, TIME, F.col(value).alias("v"))
    place, time, v = rows.schema
    values = T.ArrayType(v.dataType)
    runs = rows.mapInArrow(_runs_of_rows(), T.StructType([place, time, T.StructField("v", values)]))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # fixed: rows multiply after this small exchange
    laid = runs.repartition(tasks, SERIES).sortWithinPartitions(SERIES, TIME)
    made = T.StructType([T.StructField("lags", values), T.StructField("target", v.dataType), place, time])
    return laid.mapInArrow(_windows_of_runs(window, step), made)


def training_windows(
    series: DataFrame,
    feature_col: str = "rides",
    window_size: int = 12,
    step_size: int = 1,
    pad_short: bool = False,
    chunk: int | None = None,
    spread: bool = False,
    runs: bool = False,
) -> DataFrame:
    """Lags and target, every ``step_size`` rows from the start of each series.

    Series with no row after the first window are left out, or with ``pad_short`` extended to the left with their
    first value and time. ``spread`` lets one series span many tasks, at the price of writing the rows once: for few and
    very long series. The windows are the same.

    ``runs`` is for rows read from a keyed table, which lie in hour order by location: each stretch moves as one row.

    Of a packed series (``pack_hours``) the windows are made where its row is; no hour of it is moved, sorted or written as a row.
    """
    require_columns(series, SERIES, TIME, feature_col)
    if isinstance(series.schema[feature_col].dataType, T.ArrayType):
        return _packed(series, feature_col, window_size, step_size, pad_short or spread or runs)
    if pad_short:
        series = _pad(series, feature_col, window_size)
    if runs:
        return _sliding_runs(series, feature_col, window_size, step_size)
    return _sliding(series, feature_col, window_size, step_size, chunk, spread)


def _packed(series: DataFrame, value: str, window: int, step: int, other: bool) -> DataFrame:
    if window < 1 or step < 1:
        raise ValueError("window and step must be positive")
    if other:
        raise ValueError("packed series are neither padded nor spread, and have no runs")
    require_columns(series, "hours")
    kinds = series.schema
    lags = [T.StructField("lags", T.ArrayType(T.LongType())), T.StructField("target", T.LongType())]
    rows = series.select(SERIES, TIME, "hours", value)
    return rows.mapInArrow(_unpacked_windows(value, window, step), T.StructType([*lags, kinds[SERIES], kinds[TIME]]))


def scoring_windows(
    series: DataFrame,
    feature_col: str = "rides",
    window_size: int = 12,
    step_size: int = 1,
    anchor: str = "start",
    chunk: int | None = None,
) -> DataFrame:
    """Lags without target.

    ``anchor='start'`` gives the same windows as training (each still needs a row after it, for its time).
    ``anchor='end'`` gives one window per series: its last ``window_size`` rows, timed one hour after the last.
    """
    if anchor == "start":
        return training_windows(series, feature_col, window_size, step_size, chunk=chunk).drop("target")
    if anchor != "end":
        raise ValueError("anchor must be 'start' or 'end'")
    require_columns(series, SERIES, TIME, feature_col)
    latest = Window.partitionBy(SERIES).orderBy(F.col(TIME).desc())
    rows = series.select(SERIES, TIME, F.col(feature_col).alias("v"), F.row_number().over(latest).alias("back"))
    return (
        rows.where(F.col("back") <= window_size)
        .groupBy(SERIES)
        .agg(F.sort_array(F.collect_list(F.struct(TIME, "v"))).alias("rows"), F.max(TIME).alias("last"))
        .where(F.size("rows") == window_size)
        .select(F.col("rows.v").alias("lags"), SERIES, (F.col("last") + interval(HOUR)).alias(TIME))
    )


def short_series(series: DataFrame, window_size: int) -> DataFrame:
    """Series that give no window, with their number of rows: what ``training_windows`` leaves out."""
    return series.groupBy(SERIES).agg(F.count("*").alias("rows")).where(F.col("rows") <= window_size)


def _pad(series: DataFrame, value: str, window: int) -> DataFrame:
    """Repeat the first row of short series until they have ``window + 1`` rows."""
    rows = series.select(SERIES, TIME, value)
    whole = Window.partitionBy(SERIES)
    counted = rows.select(
        "*",
        F.row_number().over(whole.orderBy(TIME)).alias("pos"),
        F.count("*").over(whole).alias("n"),
    )
    copies = F.when(F.col("pos") == 1, F.greatest(F.lit(window + 2) - F.col("n"), F.lit(1))).otherwise(F.lit(1))
    return counted.select(SERIES, TIME, value, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("copy")).drop("copy")


def single_series_windows(
    series: DataFrame,
    location_id: int | None = None,
    feature_col: str = "rides",
    window_size: int = 12,
    step_size: int = 1,
    location_name: str | None = None,
    name_col: str = "zone",
) -> DataFrame:
    """Training windows of one series, by id or by name, as columns ``feature_1`` … ``feature_W`` and ``target``. The series may
    span many tasks."""
    chosen = series.where(F.col(name_col) == location_name) if location_name else series.where(F.col(SERIES) == location_id)
    wide = training_windows(chosen, feature_col, window_size, step_size, spread=True)
    return wide.select(
        TIME, *[F.col("lags")[i].alias(f"feature_{i + 1}") for i in range(window_size)], "target"
    )


def widen(windows: DataFrame, window_size: int, feature_col: str = "rides") -> DataFrame:
    """Array to columns ``rides_t-W`` … ``rides_t-1``. For hand-over to tools that want columns; keep the array
    otherwise."""
    lags = [F.col("lags")[i].alias(f"{feature_col}_t-{window_size - i}") for i in range(window_size)]
    return windows.select(*lags, *[c for c in windows.columns if c != "lags"])


def lag_columns(df: DataFrame, prefix: str = "rides_t-") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def narrow(wide: DataFrame, feature_col: str = "rides") -> DataFrame:
    """Columns ``rides_t-W`` … back to the array, oldest first."""
    names = sorted(lag_columns(wide, f"{feature_col}_t-"), key=lambda c: -int(c.rsplit("-", 1)[1]))
    return wide.select(F.array(*[F.col(f"`{c}`") for c in names]).alias("lags"), *[c for c in wide.columns if c not in names])


def unpivot(windows: DataFrame, last: Column | None = None) -> DataFrame:
    """One (time, value) row per lag and, at the end, the target or the given value (for example a prediction)."""
    end = F.col("target") if last is None else last
    return (
        windows.select(
            SERIES,
            F.col(TIME).alias("window_hour"),
            F.size("lags").alias("w"),
            F.posexplode(F.concat(F.col("lags").cast("array<double>"), F.array(end.cast("double")))).alias("p", "rides"),
        )
        .select(
            SERIES,
            "window_hour",
            (F.col("window_hour") + F.make_dt_interval(F.lit(0), F.col("p") - F.col("w"))).alias("datetime"),
            "rides",
        )
    )


def seasonal_lags(series: DataFrame, feature_col: str = "rides", weeks: int = 4) -> DataFrame:
    """The value 1 … ``weeks`` weeks before each row, without building windows: one pass over each ordered series."""
    require_columns(series, SERIES, TIME, feature_col)
    ordered = Window.partitionBy(SERIES).orderBy(TIME)
    return series.select(
        "*",
        *[F.lag(feature_col, WEEK * k).over(ordered).alias(f"{feature_col}_t-{WEEK * k}") for k in range(1, weeks + 1)],
        (F.row_number().over(ordered) - 1).alias("history"),
    )


def split_by_time(df: DataFrame, cutoff: datetime, time: str = TIME) -> tuple[DataFrame, DataFrame]:
    """(before ``cutoff``, from ``cutoff`` on); the target stays a column."""
    return df.where(F.col(time) < ntz(cutoff)), df.where(F.col(time) >= ntz(cutoff))


