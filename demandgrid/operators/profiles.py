"""Profiling reports: describe, histogram, box statistics, extremes, column profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.numbers import nan_to_null
from demandgrid.operators.quantiles import describe_column, exact_quantiles


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles, max in one row; three scans of the column."""
    row = describe_column(df, column, [0.25, 0.5, 0.75])
    quartiles = [F.col("quantiles")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return row.select(F.col("n").alias("count"), "mean", "std", F.col("least").alias("min"), *quartiles, F.col("most").alias("max"))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins from min to max, the last one closed, empty bins included."""
    values = df.select(nan_to_null(F.col(column).cast("double")).alias("v")).where(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where(F.col("lo").isNotNull())
    # A single repeated value gets a bin range of width 1 around it.
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    span = F.broadcast(span)  # one row
    raw = F.floor((F.col("v") - F.col("lo")) / F.col("width"))
    counted = (
        values.crossJoin(span)
        .groupBy(F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("rows"))
    )
    grid = span.select("lo", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
    )


def box_stats(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (furthest values within ``reach`` interquartile ranges) and outlier counts."""
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75]).select(
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    )
    fences = quartiles.withColumns(
        {
            "low": F.col("q1") - reach * (F.col("q3") - F.col("q1")),
            "high": F.col("q3") + reach * (F.col("q3") - F.col("q1")),
        }
    )
    v = F.col("v")
    values = df.select(nan_to_null(F.col(column).cast("double")).alias("v")).where(v.isNotNull())
    within = v.between(F.col("low"), F.col("high"))
    return (
        values.crossJoin(F.broadcast(fences))  # one row
        .groupBy("q1", "median", "q3")
        .agg(
            F.min(F.when(within, v)).alias("whisker_low"),
            F.max(F.when(within, v)).alias("whisker_high"),
            F.count_if(v < F.col("low")).alias("outliers_low"),
            F.count_if(v > F.col("high")).alias("outliers_high"),
        )
    )


def extremes(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """First and last ``n`` rows of a total order, labelled ``side``; each half is a top-k, not a full sort."""
    first = df.orderBy(*[F.asc(c) for c in order]).limit(n).withColumn("side", F.lit("first"))
    last = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("side", F.lit("last"))
    return first.unionByName(last)


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-null values. One pass over the data."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("type"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select("rows", F.inline(entries))


def pick_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """One example row, the same on every run: the row whose key hashes lowest."""
    return df.orderBy(F.xxhash64(*keys), *keys).limit(1)
