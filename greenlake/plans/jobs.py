"""Ingest jobs: each maps a source's rows to its contract, judges them by its rules, and keeps a version that passes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.operators import grid, raster
from greenlake.operators.quality_rules import RULES
from greenlake.plans import pipelines
from greenlake.sources import inventories, publish, readers


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with a point text where it has coordinates but no geometry, and x and y on the map grid."""
    if "geometry_wkt" not in df.columns:
        there = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
        df = df.withColumn("geometry_wkt", F.when(there, geo.wkt_point("longitude", "latitude")))
    if "longitude" in df.columns and "x" not in df.columns:
        x, y = geo.to_map_grid("longitude", "latitude")
        df = df.withColumns({"x": x, "y": y})
    return df


def _area(features: DataFrame) -> DataFrame:
    names = {"source_area_code": ("gccsa_code_2021", "code"), "area_name": ("gccsa_name_2021", "name"), "source_year": ("source_year",)}
    features = inventories.bound(features, _p=inventories.slug_keys(F.col("properties")))
    got = {k: inventories.first_of(F.col("_p"), *v) for k, v in names.items()}
    return features.select(*(c.alias(k) for k, c in got.items()), F.col("geometry").alias("geometry_wkt"), F.col("measured_m2").alias("area_m2"))


def _guidance(rows: DataFrame, lga: DataFrame) -> DataFrame:
    x = inventories.normalise_guidance(rows, lga, ["approved", "recommended", "conditional", "approval_required", "not_recommended"], ["small", "medium", "large"])
    return x.where(F.size("reject_reasons") == 0).drop("reject_reasons")


def _heat(cells: DataFrame) -> DataFrame:
    return cells.withColumns({"measurement_type": F.lit("land_surface_temperature"), "unit": F.lit("degree_Celsius")})


def _change(features: DataFrame) -> DataFrame:
    kinds = ("tree", "shrub", "grass", "total_vegetation")
    measures = {f"{k}_change_pct_points": (f"{k}_change", f"{k}_pct_change") for k in kinds}
    x = inventories.normalise_change(features.withColumn("geometry_wkt", F.col("geometry")), measures, ("observed_from", "observed_to", "geometry_wkt"))
    return x.where("source_feature_key is not null")


def _climate(rows: DataFrame) -> DataFrame:
    values = ["AP", "PDM", "PWM", "PDQ", "MTWM", "MAT", "MTCM", "IDM", "IP"]
    x = grid.climate_variants(rows.select(F.col("City").alias("city"), F.col("Year").alias("year"), *values), ["city", "year"], values)
    return x.withColumn("source_row_number", F.xxhash64("city", "year", "variant_number"))


def _hourly(hours: DataFrame) -> DataFrame:
    x = grid.daily_from_hourly(readers.nan_to_null(readers.resolve_cube(hours)))
    return x.withColumns({"cell_key": F.concat_ws(":", F.col("lat").cast("string"), F.col("lon").cast("string")), "geometry_wkt": geo.wkt_point("lon", "lat")})


def _land_cover(pixels: DataFrame) -> DataFrame:
    x = raster.land_cover_fractions(pixels)
    name = F.try_element_at(F.create_map(*(F.lit(v) for kv in raster.LAND_COVER.items() for v in kv)), F.col("dominant_level3_code"))
    day = F.make_date(F.col("observed_year"), F.lit(12), F.lit(31))
    return x.withColumns({"dominant_level3_name": name, "observed_on": day, "geometry_wkt": F.col("cell_key")})


@dataclass(frozen=True)
class Job:
    rules: str
    normalise: Callable[..., DataFrame]
    placed: bool = False


JOBS: dict[str, Job] = {
    "boundary": Job("analysis_area", _area),
    "lga": Job("local_government_area", inventories.normalise_lga),
    "council-guidance": Job("council_species_guidance", _guidance),
    "weather": Job("weather_observation", inventories.normalise_weather),
    "costs": Job("cost_estimate", inventories.normalise_costs),
    "addresses": Job("address", inventories.normalise_address),
    "properties": Job("parcel", inventories.normalise_parcel),
    "trees": Job("urban_tree", inventories.normalise_urban_tree, True),
    "named-trees": Job("named_tree_inventory", inventories.normalise_melbourne_trees, True),
    **{f"named-trees-{c}": Job("named_tree_inventory", lambda df, c=c: inventories.normalise_councils({c: df}), True) for c in inventories.COUNCILS},
    "canopy": Job("vegetation_observation", lambda cells: cells),
    "city-canopy": Job("canopy_snapshot_feature", lambda df, year=2021: inventories.normalise_canopy_snapshot(df, year)),
    "vegetation-change": Job("metropolitan_vegetation_change_feature", _change),
    "traits": Job("plant_trait_observation", inventories.normalise_traits),
    "growth": Job("urban_tree_growth_observation", inventories.normalise_rings),
    "growth-climate": Job("urban_tree_growth_climate", _climate),
    "heat": Job("heat_observation", _heat),
    "land-cover": Job("dea_land_cover_observation", _land_cover),
    "hourly-climate": Job("era5_land_daily_observation", _hourly),
}


def run_job(name: str, rows: DataFrame, version_id: str, boundary: DataFrame | None = None, out: str | None = None, threshold: float = 95.0, **more) -> tuple[DataFrame, DataFrame]:
    """Facts of a new version and the quality report of its rows.

    Rows that fail a rule are left out, and all are where too few pass. With a ``boundary`` of boxes, points outside it
    go too. With ``out`` both are published below it; a run of the same job and version that was published already adds nothing.
    """
    job = JOBS[name]
    x = job.normalise(rows, **more)
    x = _placed(x) if job.placed else x
    facts, report = pipelines.ingest(x, RULES[job.rules], name, version_id, boundary if job.placed else None, threshold)
    if out:
        run = [{"run_id": f"{name}|{version_id}", "version_id": version_id}]
        publish.publish(facts, f"{out}/facts/{name}", run)
        publish.publish(report, f"{out}/quality/{name}", run)
    return facts, report
