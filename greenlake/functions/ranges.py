"""Arithmetic on ``struct<minimum, maximum>`` columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def of(minimum, maximum) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(minimum).cast("double").alias("minimum"), lit(maximum).cast("double").alias("maximum"))


def valid(value: Column, fraction: bool = False) -> Column:
    """Whether a range is non-negative and ordered, and at most 1 for a fraction."""
    low, high = value["minimum"], value["maximum"]
    good = (low >= 0) & (high >= low) & ((high <= 1) if fraction else F.lit(True))
    return F.coalesce(good & ~F.isnan(low) & ~F.isnan(high), F.lit(False))


def multiply(*values: Column) -> Column:
    return of(reduce(lambda a, b: a * b, [v["minimum"] for v in values]), reduce(lambda a, b: a * b, [v["maximum"] for v in values]))


def scale(value: Column, by) -> Column:
    return of(value["minimum"] * by, value["maximum"] * by)


def rounded(value: Column, digits: int = 3) -> Column:
    return of(F.round(value["minimum"], digits), F.round(value["maximum"], digits))
