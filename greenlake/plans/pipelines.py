"""Jobs that join the operators: gated ingest, clips, baselines, parcel canopy, classification schemes, sanity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlake.functions import classify, geo
from greenlake.operators import grid, quality, raster, spatial_join, versions
from greenlake.sources.scratch import written


def ingest(rows: DataFrame, rules: Sequence[dict], dataset: str, version_id: str, boundary: DataFrame | None = None, threshold: float = 95.0) -> tuple[DataFrame, DataFrame]:
    """Facts of a new version and its quality report: the passing rows, within the boundary where there is one, or none. ``rows`` are read once."""
    judged = quality.judge(rows, rules, dataset, threshold)
    kept = judged.kept()
    if boundary is not None:
        kept = spatial_join.points_in_areas(kept, boundary, "left_semi")
    return kept.withColumn("version_id", F.lit(version_id)), judged.report.withColumn("version_id", F.lit(version_id))


def clip(facts: DataFrame, boundary: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Facts within a boundary under their child version's id, and for each parent how many went in and stayed."""
    kept = spatial_join.points_in_areas(facts, boundary, "left_semi")
    child = F.sha2(F.concat_ws("|", F.lit(name), F.col("version_id").cast("string")), 256)
    a = facts.groupBy("version_id").agg(F.count("*").alias("n_in"))
    b = kept.groupBy("version_id").agg(F.count("*").alias("n_out"))
    report = a.join(b, "version_id", "left").withColumn("n_out", F.coalesce("n_out", F.lit(0)))
    report = report.withColumns({"n_excluded": F.col("n_in") - F.col("n_out"), "retention_pct": F.round(F.col("n_out") / F.col("n_in") * 100, 2)})
    return kept.withColumns({"parent_version_id": F.col("version_id"), "version_id": child}), report


def membership_evidence(clipped: DataFrame, rule: str) -> DataFrame:
    """Evidence that all rows of each clipped version are members, by the rule that made it so."""
    return clipped.groupBy("version_id").agg(F.count("*").alias("records")).select("version_id", F.lit(rule).alias("membership_rule"), "records", F.lit(100.0).alias("pass_rate"))


def quality_summary(reports: DataFrame, threshold: float = 95.0) -> DataFrame:
    """The overall row of each report, with whether it passes the gate."""
    return reports.where("rule_code is null").select("dataset", "assessed", "passed", "pass_rate", ((F.col("assessed") > 0) & (F.col("passed") / F.nullif("assessed", F.lit(0)) * 100 >= threshold)).alias("passed_kpi_1_gate"))


def heat_baseline(heat: DataFrame, low: float = -50.0, high: float = 80.0) -> tuple[DataFrame, DataFrame]:
    """The heat mosaic with its bands, and the checks of the grid."""
    x = grid.heat_mosaic(heat).withColumn("band", classify.temperature_band("heat_value"))
    return x, quality.baseline_checks(x, ["cell_id"], ["cell_id", "heat_value"], "heat_value", low, high)


def canopy_baseline(cells: DataFrame, heat_cells: DataFrame, kind: str, source_type: str) -> tuple[DataFrame, DataFrame]:
    """Canopy cells of one vegetation type stamped with their source, and how well they cover the heat grid."""
    x = cells.where(F.col("vegetation_type") == kind).withColumns({"source_type": F.lit(source_type), "is_proxy": F.lit(source_type == "api_tile_proxy")})
    return x, quality.grid_alignment(heat_cells, x)


def parcel_canopy_build(parcels: DataFrame, pixels: DataFrame, done: DataFrame, pixel_area: float) -> tuple[DataFrame, DataFrame]:
    """Canopy of the parcels that are not done yet, with those that are, and whether the whole may be published."""
    todo = parcels.join(done.select("parcel_id"), "parcel_id", "left_anti")
    x = done.unionByName(raster.parcel_canopy(todo, pixels, pixel_area))
    return x, raster.publishable(x, parcels)


def classification_scheme(cells: DataFrame, metrics: Sequence[str], version: str) -> DataFrame:
    """Tercile thresholds of each metric as one scheme version; a metric without samples is an error."""
    out = None
    for m in metrics:
        t = grid.tercile_thresholds(cells, m).select(F.lit(version).alias("scheme_version"), F.lit(m).alias("metric"), "lower", "upper", "samples")
        t = t.withColumn("samples", F.when(F.col("samples") > 0, F.col("samples")).otherwise(F.raise_error(F.lit(f"no samples for {m}")).cast("bigint")))
        out = t if out is None else out.unionByName(t)
    return out


def by_scheme(cells: DataFrame, scheme: DataFrame, metric: str) -> DataFrame:
    """Cells with their band under a scheme's thresholds for a metric; the scheme's row is one, and broadcast."""
    row = scheme.where(F.col("metric") == metric).select(F.col("lower").alias("_lower"), F.col("upper").alias("_upper"))
    return cells.join(F.broadcast(row), F.lit(True), "left").withColumn("band", classify.between_bounds(metric, "_lower", "_upper")).drop("_lower", "_upper")


def publish_scheme(published: DataFrame, new: DataFrame, day: Column) -> DataFrame:
    """Published scheme rows (scheme_version, metric, status, valid_from, valid_to, ...) with a new version in force from a day on.

    Rows of other versions that are still active end on that day and are retired; the new version's are replaced.
    """
    own = new.select("scheme_version").distinct()
    old = published.join(F.broadcast(own), "scheme_version", "left_anti")  # a new version's own name, one row
    active = F.col("status") == "active"
    old = old.withColumns({"valid_to": F.when(active, day).otherwise(F.col("valid_to")), "status": F.when(active, "retired").otherwise(F.col("status"))})
    return old.unionByName(new.withColumns({"status": F.lit("active"), "valid_from": day, "valid_to": F.lit(None).cast("date")}), allowMissingColumns=True)


def run_rows(children: DataFrame, job: str, started: Column) -> DataFrame:
    """One run row for each derived version, under an id that follows from it, so a repeated run adds none."""
    return children.select(F.sha2(F.concat_ws("|", F.lit(job), F.col("version_id").cast("string")), 256).alias("run_id"), "version_id", "parent_version_id", F.lit(job).alias("job"), started.alias("started_at"), F.lit("completed").alias("status"))


def geometry_checks(cells: DataFrame, boundary: DataFrame) -> DataFrame:
    """Share of a grid's boxes that have an area, and of those whose centre a boundary's boxes hold."""
    ok = (F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax"))
    x = cells.select("cell_id", F.coalesce(ok, F.lit(False)).alias("_valid"), ((F.col("xmin") + F.col("xmax")) / 2).alias("x"), ((F.col("ymin") + F.col("ymax")) / 2).alias("y"))
    inside = spatial_join.points_in_areas(x, boundary.select("xmin", "ymin", "xmax", "ymax"), "left_semi")
    a = x.agg(F.count("*").alias("cells"), F.count_if("_valid").alias("n_valid"))
    b = inside.agg(F.count_if("_valid").alias("n_covered"))
    rate = lambda n, d: F.round(F.col(n) / F.nullif(F.col(d), F.lit(0)) * 100, 2)
    return a.join(F.broadcast(b), F.lit(True)).select("cells", rate("n_valid", "cells").alias("valid_rate"), rate("n_covered", "n_valid").alias("covered_rate"))


def close_superseded(all_versions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Versions with the contained ones retired, which version holds them, and the limitation that says so."""
    x = all_versions.join(pairs, all_versions["version_id"] == pairs["partial"], "left")
    return x.withColumns({"integration_status": F.when(F.col("partial").isNotNull(), "retired").otherwise(F.col("integration_status")), "superseded_by": F.col("complete"), "limitation": F.when(F.col("partial").isNotNull(), F.concat(F.lit("superseded_by:"), F.col("complete").cast("string")))}).drop("partial", "complete")


def latest_case_results(results: DataFrame) -> DataFrame:
    """The newest result of each case and model."""
    return versions.latest_version(results, ["case_code", "model_code"], ["run_at", "result_id"])


def coverage_gaps(scenarios: DataFrame, column: str, required: Sequence[str]) -> DataFrame:
    """Required values that no scenario has."""
    wanted = scenarios.sparkSession.createDataFrame([(v,) for v in required], f"{column} string")
    return wanted.exceptAll(wanted.join(scenarios, column, "left_semi")).select(F.col(column).alias("missing"))


def property_sanity(x: DataFrame, as_of: Column) -> DataFrame:
    """Failures and warnings of every property's answers as codes, and PASS, WARN or FAIL.

    Reads n_matches, inside_boundary, area_m2, lot_size, expected_lot_size, longitude, latitude, heat_value, heat_class,
    heat_observed_on, canopy_pct, canopy_class, property_canopy_pct, is_proxy, scheme_version, n_trees, weather_status,
    distance_km and air_temperature_c. What is missing fails; a class must be Unavailable exactly where its value is null.
    """
    age, km, weather = F.date_diff(as_of, "heat_observed_on"), F.col("distance_km"), F.col("weather_status")
    canopy, own, air = F.col("canopy_pct"), F.col("property_canopy_pct"), F.col("air_temperature_c")
    bands = ("Low", "Medium", "High")

    def bad_class(value, name):
        return F.when(F.col(value).isNull(), ~F.col(name).eqNullSafe("Unavailable")).otherwise(~F.coalesce(F.col(name).isin(*bands), F.lit(False)))

    weather_fits = (
        F.when(weather == "good_local_context", (km <= 10) & air.isNotNull()).when(weather == "regional_context_warning", (km > 10) & (km <= 25))
        .when(weather == "too_distant_temperature_suppressed", (km > 25) & air.isNull()).when(weather == "unavailable_no_observation_within_3_hours", air.isNull())
    )
    wrong = {
        "not_one_match": F.col("n_matches") != 1, "outside_boundary": ~F.col("inside_boundary"), "bad_area": F.col("area_m2") <= 0, "other_lot_size": F.col("lot_size") != F.col("expected_lot_size"),
        "bad_coordinates": ~(F.col("longitude").between(144.0, 146.0) & F.col("latitude").between(-39.5, -37.0)), "bad_heat": ~F.col("heat_value").between(-20, 80),
        "bad_heat_class": bad_class("heat_value", "heat_class"), "bad_heat_date": age < 0, "bad_canopy": ~canopy.between(0, 100), "bad_canopy_class": bad_class("canopy_pct", "canopy_class"),
        "bad_property_canopy": ~own.between(0, 100), "property_canopy_is_proxy": F.col("is_proxy"), "no_scheme_version": F.col("scheme_version") == "", "bad_tree_count": F.col("n_trees") < 0,
        "weather_contradiction": ~weather_fits,
    }
    odd = {
        "old_heat": age > 365, "extreme_canopy": (canopy <= 1) | (canopy >= 90), "extreme_property_canopy": (own <= 1) | (own >= 90), "no_trees": F.col("n_trees") == 0,
        "distant_weather": ((weather == "regional_context_warning") & (km > 10) & (km <= 25)) | ((weather == "too_distant_temperature_suppressed") & (km > 25)), "no_recent_weather": weather == "unavailable_no_observation_within_3_hours",
    }
    failures = F.concat_ws(",", *(F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in wrong.items()))
    warnings = F.concat_ws(",", *(F.when(c, F.lit(k)) for k, c in odd.items()))
    x = x.withColumns({"failures": failures, "warnings": warnings})
    return x.withColumn("status", F.when(F.col("failures") != "", "FAIL").when(F.col("warnings") != "", "WARN").otherwise("PASS"))


def prepare_vector(features: DataFrame, polygon: str = "polygon", clip_to: DataFrame | None = None, key: str | None = None, degrees: bool = False) -> tuple[DataFrame, DataFrame]:
    """Sound polygons with area and box, within a box table where there is one, and counts of what was done to them.

    Rings are closed, and rid of repeated points and spikes; ``repaired`` tells where that changed one. Left out are null polygons, invalid
    ones (no area, or fewer than three corners) and, with a ``key``, those whose sides cross or touch each other (a cut of a ring into
    sound parts would be a guess). With ``degrees`` polygons are brought to the map grid first.
    """
    raw = geo.on_map_grid(F.col(polygon)) if degrees else F.col(polygon).cast(geo.POLYGON)
    x = features.withColumn("_raw", raw).withColumn(polygon, geo.tidied(F.col("_raw")))
    x = x.withColumns({"repaired": F.coalesce(F.col("_raw") != F.col(polygon), F.lit(False)), "_ok": geo.valid_polygon(F.col(polygon))}).drop("_raw")
    if key is not None:
        x = written(x, "tidied")
        crossed = spatial_join.self_crossings(x.where("_ok"), key, polygon).select(key).distinct().withColumn("_crossed", F.lit(True))
        x = x.join(crossed, key, "left").withColumn("_crossed", F.coalesce("_crossed", F.lit(False)))
    else:
        x = x.withColumn("_crossed", F.lit(False))
    good = F.col("_ok") & ~F.col("_crossed")
    report = x.agg(
        F.count("*").alias("n_in"), F.count_if(F.col(polygon).isNull()).alias("n_null"), F.count_if(F.col(polygon).isNotNull() & ~F.col("_ok")).alias("n_invalid"),
        *([F.count_if("_crossed").alias("n_crossed"), F.count_if(good & F.col("repaired")).alias("n_repaired")] if key is not None else []),
    )
    x = x.where(good).drop("_ok", "_crossed").withColumn("area_m2", geo.polygon_area(F.col(polygon))).withColumns(geo.bounds(F.col(polygon)))
    return (x if clip_to is None else spatial_join.areas_meet(x, clip_to)), report


def lot_canopy(parcels: DataFrame, trees: DataFrame) -> DataFrame:
    """Trees in each parcel, and their crown area as a share of the parcel's."""
    crown = F.pi() * F.col("radius") * F.col("radius")
    n = spatial_join.sums_in_areas(parcels, trees, "parcel_id", {"n_trees": F.lit(1), "crown_m2": crown})
    x = parcels.select("parcel_id", "area_m2").join(n, "parcel_id", "left")
    return x.select("parcel_id", F.coalesce("n_trees", F.lit(0)).alias("n_trees"), F.round(F.coalesce("crown_m2", F.lit(0.0)) / F.col("area_m2") * 100, 2).alias("crown_pct"))
