"""Column arithmetic with the null rules of the data model."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_mean(*cols: Column) -> Column:
    """Mean across columns of one row, nulls skipped, null when all are null."""
    total = reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    present = reduce(add, [c.isNotNull().cast("int") for c in cols])
    return total / F.nullif(present, F.lit(0))


def round_half_even(col: Column, scale: int = 0) -> Column:
    return F.bround(col, scale)


def floor_at(col: Column, lower: float) -> Column:
    """Clip from below; null stays null (``greatest`` alone would turn it into the bound)."""
    return F.when(col.isNotNull(), F.greatest(col, F.lit(lower)))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)
