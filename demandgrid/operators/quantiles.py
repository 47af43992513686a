"""Exact quantiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_SIZE = 800  # rank error about 0.4 %, some 20 kB
SALTS = 64  # partial merges per bucket
MARGIN = 0.005  # on either side of a wanted probability, to cover the sketch's error
SLICES, PER_OCTAVE = 4000, 62  # slots per enclosure; their number each time the distance to the nearer end doubles
CALENDAR = frozenset({"year", "month", "day", "date", "year_month"})


def _brackets(probs: Sequence[float]) -> list[tuple[float, float]]:
    """Probability intervals around the requested ones, overlapping intervals merged."""
    out: list[tuple[float, float]] = []
    for p in sorted(set(probs)):
        lo, hi = max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _cuts(rows: DataFrame, by: list[str], ends: list[float]) -> DataFrame:
    """Approximate quantiles at ``ends`` per bucket, as array ``cuts``.

    The sketches of very many tasks would queue up at one reducer, so they are merged per bucket and salt first.
    """
    salted = rows.groupBy(*by, (F.spark_partition_id() % SALTS).alias("salt")).agg(
        F.kll_sketch_agg_double("v", F.lit(SKETCH_SIZE)).alias("sketch")
    )
    merged = salted.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"))
    filled = F.kll_sketch_get_n_double("sketch") > 0
    at_ends = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in ends]))
    return merged.select(*by, F.when(filled, at_ends).alias("cuts"))


def _slot(brackets: list[tuple[float, float]]) -> Column:
    """Ordinal of the stretch of the number line that holds ``v``: gap, slices of an enclosure, gap, …

    Slices are narrow near either end of their enclosure and double in width towards its middle, so values that crowd at
    one end, because a single huge value lies at the other, still fall into many slices.
    """
    width, half, cases = SLICES + 1, SLICES // 2, []
    for i in range(len(brackets)):
        lo, hi = f"cuts[{2 * i}]", f"cuts[{2 * i + 1}]"
        octaves = lambda x: f"floor(log2(2 * try_divide({x}, {hi} - {lo})) * {PER_OCTAVE})"
        lower = f"coalesce(greatest({half - 1} + {octaves(f'v - {lo}')}, 0), 0)"
        upper = f"coalesce(least({half} - {octaves(f'{hi} - v')}, {SLICES - 1}), {SLICES - 1})"
        nearer = f"CASE WHEN v - {lo} < {hi} - v THEN least({lower}, {half - 1}) ELSE greatest({upper}, {half}) END"
        cases.append(f"WHEN v < {lo} THEN {i * width}")
        cases.append(f"WHEN v <= {hi} THEN {i * width + 1} + {nearer}")
    return F.expr(f"int(CASE {' '.join(cases)} ELSE {len(brackets) * width} END)")


def _ranks(p: float) -> tuple[str, str]:
    """SQL for the two zero-based ranks that the quantile lies between, among ``n`` rows."""
    return f"floor({p}D * (n - 1))", f"least(floor({p}D * (n - 1)) + 1, n - 1)"


def _interpolated(i: int, p: float) -> str:
    # Anchored at the nearer neighbour, so that a share of 0 or 1 returns it unchanged.
    t = f"({p}D * (n - 1) - floor({p}D * (n - 1)))"
    between = f"if({t} < 0.5D, lo{i} + (hi{i} - lo{i}) * {t}, hi{i} - (hi{i} - lo{i}) * (1 - {t}))"
    inf = "double('infinity')"
    ends = f"CASE WHEN lo{i} = -{inf} AND hi{i} = {inf} THEN if({t} < 0.5D, lo{i}, hi{i}) WHEN hi{i} = {inf} THEN hi{i} ELSE lo{i} END"
    return f"CASE WHEN {t} = 0 OR lo{i} = hi{i} THEN lo{i} WHEN abs(lo{i}) = {inf} OR abs(hi{i}) = {inf} THEN {ends} ELSE {between} END"


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` (NaN and null skipped) per calendar bucket ``by``, or overall.

    Three scans of the one column, none of which sends a bucket's rows to one task:

    1. a sketch encloses each quantile between two values;
    2. rows are counted per slot of the number line (each enclosure cut into slices, and the gaps between), combined before the
       shuffle; the running total over these few slots tells which slot holds each wanted rank, and how many rows lie
       before it;
    3. the distinct values between the least and greatest of a wanted slot are counted and ranked.

    The slots cover every value and the counts are exact, so the result is exact whatever the sketch says; a poor
    sketch only makes the last step larger. Infinities are values like others; strictly between a value and an infinity the
    quantile is the infinity, between both infinities the nearer one.

    ``by`` must be calendar columns (``CALENDAR``): the enclosures and wanted slots are broadcast, and a calendar bounds
    their number (12 or 366 buckets a year).

    Returns ``by`` columns, ``n`` (rows counted) and ``quantiles`` (array in the order of ``probs``).
    """
    by, probs = list(by), [float(p) for p in probs]
    if not set(by) <= CALENDAR:
        raise ValueError(f"buckets must be calendar columns {sorted(CALENDAR)}, not {by}")
    return _quantiles(df.select(*by, F.col(value).cast("double").alias("v")), by, probs)


def exact_quantiles_of(df: DataFrame, values: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``measure, n, quantiles`` for several columns, in the same three scans as for one."""
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in values])
    return _quantiles(df.select(F.inline(pairs)), ["measure"], [float(p) for p in probs])


def describe_column(df: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """One row: ``n, quantiles, mean, std, least, most`` (sample deviation). The moments come from the counts per slot, so there
    is no scan of their own."""
    return _quantiles(df.select(F.col(value).cast("double").alias("v")), [], [float(p) for p in probs], moments=True)


MOMENTS = ("mean", "squares", "lowest", "highest")


def _with_moments(slots: DataFrame, bucket: Window) -> DataFrame:
    """Each slot's row with the mean, the squares about it, and the ends of its bucket, merged from those of the slots."""
    c, off = F.col("c"), F.col("m") - F.col("mean")
    merged = slots.withColumn("mean", F.sum(c * F.col("m")).over(bucket) / F.sum("c").over(bucket))
    return merged.withColumns({
        "squares": F.sum(c * (F.col("var") + off * off)).over(bucket),
        "lowest": F.min("least").over(bucket), "highest": F.max("most").over(bucket),
    })


def _quantiles(rows: DataFrame, by: list[str], probs: list[float], moments: bool = False) -> DataFrame:
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan("v"))
    brackets = _brackets(probs)
    cuts = F.broadcast(_cuts(rows, by, [p for pair in brackets for p in pair]))
    placed = (rows.join(cuts, by) if by else rows.crossJoin(cuts)).select(*by, _slot(brackets).alias("slot"), "v")

    bucket = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    more = [F.avg("v").alias("m"), F.var_pop("v").alias("var")] if moments else []
    counted = placed.groupBy(*by, "slot").agg(F.count("*").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"), *more)
    counted, carried = (_with_moments(counted, bucket), MOMENTS) if moments else (counted, ())
    running = F.sum("c").over(bucket.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    slots = counted.select(
        *by, "least", "most", (running - F.col("c")).alias("before"), running.alias("upto"), F.sum("c").over(bucket).alias("n"),
        *carried,
    )

    def holds(rank: str) -> str:
        return f"(before <= {rank} AND {rank} < upto)"

    # At most two slots per quantile and bucket. They are passed on as value ranges: the last scan does not depend on
    # the sketch, which may differ between evaluations.
    wanted = " OR ".join(holds(rank) for p in probs for rank in _ranks(p))
    wanted = F.broadcast(slots.where(wanted).select(*by, "least", "most", "before", "n", *carried))
    near = rows.join(wanted, by) if by else rows.crossJoin(wanted)
    values = near.where("v BETWEEN least AND most").groupBy(*by, "before", "n", "v", *carried).agg(F.count("*").alias("c"))
    in_slot = Window.partitionBy(*by, "before").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("c").over(in_slot)
    values = values.select(*by, "n", "v", *carried, (upto - F.col("c")).alias("before"), upto.alias("upto"))
    picks = [
        F.expr(f"max(if({holds(rank)}, v, NULL))").alias(f"{side}{i}")
        for i, p in enumerate(probs)
        for side, rank in zip(("lo", "hi"), _ranks(p))
    ]
    found = values.groupBy(*by).agg(F.expr("coalesce(max(n), 0)").alias("n"), *picks, *[F.max(c).alias(c) for c in carried])
    out = ", ".join(_interpolated(i, p) for i, p in enumerate(probs))
    found = found.select(*by, "n", F.expr(f"array({out})").alias("quantiles"), *carried)
    if not moments:
        return found
    std = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    return found.select(*by, "n", "quantiles", "mean", std.alias("std"), F.col("lowest").alias("least"), F.col("highest").alias("most"))
