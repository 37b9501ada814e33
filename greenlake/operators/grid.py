"""Grids over time: heat mosaics, hourly to daily aggregates, trait and class summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenlake.sources.scratch import written


def heat_daily(heat: DataFrame) -> DataFrame:
    """Cell-day aggregate of heat values over scenes."""
    return heat.groupBy("cell_id", "observed_on").agg(
        F.avg("heat_value").alias("heat_value"), F.min("heat_value").alias("min_value"), F.max("heat_value").alias("max_value"),
        F.count("*").alias("n_values"), F.count_distinct("source_scene_id").alias("n_scenes"),
        F.sort_array(F.collect_set("source_scene_id")).alias("source_scene_ids"),
    )


def heat_mosaic(heat: DataFrame) -> DataFrame:
    """The latest day of each cell with its mean and spread; days are never averaged together.

    Old days are dropped before their scenes are gathered: the latest day of a cell is a partially
    aggregated maximum that is joined back.
    """
    last = heat.groupBy("cell_id").agg(F.max("observed_on").alias("observed_on"))
    day = heat_daily(heat.join(last, ["cell_id", "observed_on"], "left_semi"))
    return day.withColumn("spread", F.col("max_value") - F.col("min_value"))


def daily_from_hourly(hours: DataFrame) -> DataFrame:
    """Daily weather of each cell from hourly values; kelvin days (median over 150) become Celsius.

    Sums of nothing are 0; hours whose values are all null do not make a day; hour_count counts the day's
    distinct hours. One shuffle on cell and day: the median is computed with the rest.
    """
    fields = ["t2m", "tp", "swvl1", "ssrd", "u10", "v10"]
    x = hours.where(F.coalesce(*fields).isNotNull()).withColumn("observed_on", F.to_date("ts"))
    kelvin = F.percentile("t2m", F.lit(0.5)) > 150
    shift = F.when(kelvin, 273.15).otherwise(0.0)
    return x.groupBy("lat", "lon", "observed_on").agg(
        (F.avg("t2m") - shift).alias("air_temperature_mean_c"), (F.min("t2m") - shift).alias("air_temperature_min_c"), (F.max("t2m") - shift).alias("air_temperature_max_c"),
        (F.coalesce(F.sum("tp"), F.lit(0.0)) * 1000).alias("precipitation_total_mm"), F.avg("swvl1").alias("soil_water_layer_1_mean_m3_m3"),
        (F.coalesce(F.sum("ssrd"), F.lit(0.0)) / 1e6).alias("surface_solar_radiation_total_mj_m2"),
        F.avg(F.sqrt(F.col("u10") * F.col("u10") + F.col("v10") * F.col("v10"))).alias("wind_speed_mean_ms"), F.count_distinct("ts").alias("hour_count"),
    )


def trait_summary(traits: DataFrame) -> DataFrame:
    return traits.groupBy("taxon_name", "trait_name").agg(
        F.count("*").alias("n"), F.count("value_numeric").alias("n_numeric"), F.min("value_numeric").alias("min_value"), F.max("value_numeric").alias("max_value"),
        F.percentile("value_numeric", F.lit(0.5)).alias("median_value"),
    )


def percentiles(rows: DataFrame, value: str, shares: Sequence[float]) -> DataFrame:
    """One row with exact interpolated percentiles ``p0``, ``p1``, ... of a column of doubles, and ``n``, its values that are not null.

    The values are counted, sorted by ranges and stored; totals of the ranges, one row each, tell at which rank a range starts, so
    no task gathers the values of more than one range.
    """
    sums = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    x = written(sums.orderBy("v").withColumn("part", F.spark_partition_id()), "percentiles")
    parts = x.groupBy("part").agg(F.sum("c").alias("c"))
    starts = parts.select("part", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    total = parts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    # Ranks from 0: a percentile is within the stretch between two of them.
    places = [(F.lit(float(q)) * (F.col("n") - 1)).alias(f"at{i}") for i, q in enumerate(shares)]
    r = x.join(F.broadcast(starts), "part").withColumn("before", F.col("before") + F.sum("c").over(Window.partitionBy("part").orderBy("v")) - F.col("c"))
    r = r.join(F.broadcast(total.select("n", *places)), F.lit(True))
    at = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("c")), F.col("v")))
    found = [at(f(f"at{i}")).alias(f"{k}{i}") for i in range(len(shares)) for k, f in (("low", F.floor), ("high", F.ceil))]
    one = total.select("n", *places).join(F.broadcast(r.agg(*found)), F.lit(True))

    def between(i):
        p, low, high = (F.col(f"{k}{i}") for k in ("at", "low", "high"))
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return one.select(*(between(i).alias(f"p{i}") for i in range(len(shares))), "n")


def tercile_thresholds(cells: DataFrame, value: str) -> DataFrame:
    return percentiles(cells, value, [1.0 / 3, 2.0 / 3]).select(F.col("p0").alias("lower"), F.col("p1").alias("upper"), F.col("n").alias("samples"))


def class_distribution(cells: DataFrame, bands: dict[str, Column]) -> DataFrame:
    """Counts by metric and band; all metrics in one pass over the cells."""
    pairs = F.array(*(F.struct(F.lit(m).alias("metric"), b.alias("band")) for m, b in bands.items()))
    return cells.select(F.inline(pairs)).groupBy("metric", "band").agg(F.count("*").alias("n"))


def climate_variants(rows: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Exact duplicates collapsed with their count, variants numbered within a key, and marked where there are several."""
    x = rows.groupBy(*key, *values).agg(F.count("*").alias("source_occurrence_count"))
    w = Window.partitionBy(*key)
    x = x.withColumn("variant_number", F.row_number().over(w.orderBy(*(F.asc_nulls_first(v) for v in values))))
    return x.withColumn("ambiguous", F.count("*").over(w) > 1)


def ring_sequence(rows: DataFrame) -> DataFrame:
    """Running number of a tree's rings in source order."""
    w = Window.partitionBy("city", "species_name", F.coalesce(F.nullif("tree_number", F.lit(0)), F.lit(-1))).orderBy("source_row_number")
    return rows.withColumn("ring_sequence", F.row_number().over(w))


def profile(rows: DataFrame, key: str, numbers: list[str], categories: list[str]) -> DataFrame:
    """Medians of numbers and modes of categories, the least on a tie."""
    return rows.groupBy(key).agg(*(F.percentile(c, F.lit(0.5)).alias(c) for c in numbers), *(F.mode(c, True).alias(c) for c in categories))


def canopy_by_view(trees: DataFrame, size: float) -> DataFrame:
    """Trees, crown area and its share of each square view; a missing or zero radius counts as 2 m."""
    r = F.when(F.coalesce("radius", F.lit(0.0)) == 0, 2.0).otherwise(F.col("radius"))
    x = trees.select(F.floor(F.col("x") / size).alias("vx"), F.floor(F.col("y") / size).alias("vy"), (F.pi() * r * r).alias("a"))
    return x.groupBy("vx", "vy").agg(F.count("*").alias("n_trees"), F.sum("a").alias("canopy_m2")).withColumn("canopy_pct", F.col("canopy_m2") / F.lit(size * size) * 100)
