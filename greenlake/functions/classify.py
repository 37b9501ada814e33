"""Bands for temperature, canopy, thresholds and lot size; missing and non-finite values are Unavailable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from greenlake.functions.text import col

# Band limits.
TEMPERATURE_LOW_MAX, TEMPERATURE_MEDIUM_MAX = 27.0, 30.0
CANOPY_MEDIUM, CANOPY_HIGH = 15.3, 30.0
DAILY_MEAN_HIGH = 30.0
LOT_SMALL_BELOW, LOT_MEDIUM_MAX = 400.0, 800.0


def finite(value) -> Column:
    x = col(value).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def between_bounds(value, lower, upper) -> Column:
    """Low up to ``lower``, Medium up to ``upper``, High above; an error when they are out of order."""
    x, low, high = finite(value), finite(lower), finite(upper)
    return (
        F.when(x.isNull() | low.isNull() | high.isNull(), "Unavailable")
        .when(low > high, F.raise_error(F.lit("lower threshold exceeds upper threshold")))
        .when(x <= low, "Low").when(x <= high, "Medium").otherwise("High")
    )


def temperature_band(value) -> Column:
    return between_bounds(value, F.lit(TEMPERATURE_LOW_MAX), F.lit(TEMPERATURE_MEDIUM_MAX))


def canopy_band(value, strict: bool = False) -> Column:
    """Low below 15.3, Medium below 30, else High; outside 0 to 100 it is an error, or Unavailable unless strict."""
    x = finite(value)
    outside = F.raise_error(F.lit("canopy percentage must be between 0 and 100")) if strict else F.lit("Unavailable")
    return (
        F.when(x.isNull(), "Unavailable").when(~x.between(0, 100), outside)
        .when(x >= CANOPY_HIGH, "High").when(x >= CANOPY_MEDIUM, "Medium").otherwise("Low")
    )


def by_metric(metric, value) -> Column:
    """The band of a value by its metric's name; an unknown metric is Unavailable."""
    return (
        F.when(col(metric) == "temperature", temperature_band(value))
        .when(col(metric) == "canopy", canopy_band(value)).otherwise("Unavailable")
    )


def lot_size(area) -> Column:
    x = finite(area)
    return (
        F.when(x.isNull() | (x <= 0), "unknown").when(x < LOT_SMALL_BELOW, "small")
        .when(x <= LOT_MEDIUM_MAX, "medium").otherwise("large")
    )


def daily_mean_context(maximum, minimum) -> Column:
    """Struct of the mean of a day's maximum and the next night's minimum, and its side of the old 30 C threshold."""
    mean = (finite(maximum) + finite(minimum)) / 2
    said = (
        F.when(mean.isNull(), "Unavailable").when(mean >= DAILY_MEAN_HIGH, "At or above historical 30 C threshold")
        .otherwise("Below historical 30 C threshold")
    )
    return F.struct(said.alias("classification"), F.round(mean, 3).alias("daily_mean_c"), F.lit("historical_context").alias("status"))
