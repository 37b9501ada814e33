"""Weather context: the latest observation of each station, and the nearest recent one of each property."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlake.operators.property import distance_status
from greenlake.sources.scratch import written

PAST, AHEAD = "3 hours", "5 minutes"


def latest_by_station(observations: DataFrame, as_of: Column) -> DataFrame:
    """The newest observation of each station from 3 hours before to 5 minutes after ``as_of``."""
    x = observations.where((F.col("observed_at") >= as_of - F.expr(f"interval {PAST}")) & (F.col("observed_at") <= as_of + F.expr(f"interval {AHEAD}")))
    rest = [c for c in x.columns if c != "station_code"]
    order = F.struct("observed_at", *[c for c in ("extracted_at", "observation_id") if c in rest])
    return x.groupBy("station_code").agg(F.max_by(F.struct(*rest), order).alias("o")).select("station_code", "o.*")


def nearest_recent(places: DataFrame, observations: DataFrame, as_of: Column, key: str = "parcel_id") -> DataFrame:
    """Each place's nearest station with a recent observation, its age and distance; beyond 25 km the values are withheld.

    Some tens of stations are searched as literals, more through grid buckets.
    """
    from greenlake.operators.spatial_join import nearest

    s = written(latest_by_station(observations, as_of), "stations")  # one row for each; read to search and to join
    near = nearest(places.select(key, "x", "y"), s, key, "station_code")
    x = near.join(s.drop("x", "y"), "station_code")
    age = F.greatest((F.unix_timestamp(as_of) - F.unix_timestamp("observed_at")) / 60, F.lit(0.0))
    shown = F.col("distance_m") <= 25_000
    return x.select(
        key, "station_code", F.round(F.col("distance_m") / 1000, 2).alias("distance_km"), F.round(age, 1).alias("age_minutes"),
        distance_status("distance_m").alias("context_status"), F.when(shown, F.col("air_temperature_c")).alias("air_temperature_c"),
    )
