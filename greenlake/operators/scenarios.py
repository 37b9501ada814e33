"""Greening measures and scenarios: tables of inputs in, tables of ranges and checks out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.functions import ranges

# Evidence bounds of each action's temperature effect (metric, maximum in C).
BOUNDS = {"tree": ("land_surface_temperature", 6.0), "garden_bed": ("land_surface_temperature", 6.0), "green_wall": ("wall_surface_temperature", 15.5), "potted_plants": (None, None)}

# What an action's area is, and the priced options that stand for it.
AREA_TYPES = {"tree": "canopy_area_proxy_for_shade", "potted_plants": "projected_foliage_area", "garden_bed": "established_vegetated_area", "green_wall": "established_green_wall_area"}
COST_OPTIONS = {"tree": ("backyard_tree_diy", "backyard_tree_installed"), "potted_plants": ("potted_plants",), "garden_bed": ("garden_bed",), "green_wall": ("green_wall",)}

# The example inputs of each action
# (action, quantity, unit area, survival, suitability, overlap, cover, target area; pairs are minimum and maximum).
EXAMPLES = (
    ("tree", 1, 6.6, 43.7, 0.5, 1.0, 0.5, 1.0, 1.0, 1.0, 1.0, 1.0, None),
    ("potted_plants", 4, 0.15, 0.3, 0.7, 1.0, 0.7, 1.0, 1.0, 1.0, 1.0, 1.0, None),
    ("garden_bed", 1, 16.0, 20.0, 0.7, 1.0, 0.7, 1.0, 1.0, 1.0, 0.8, 1.0, None),
    ("green_wall", 1, 8.0, 10.0, 0.7, 1.0, 0.7, 1.0, 1.0, 1.0, 0.8, 1.0, 10.0),
)
EXAMPLE_SCHEMA = (
    "action string, quantity int, unit_min double, unit_max double, survival_min double, survival_max double, suitability_min double, suitability_max double, "
    "overlap_min double, overlap_max double, cover_min double, cover_max double, target_area_m2 double"
)

# Yearly benefits of a square metre of canopy.
BENEFITS = {"carbon_kg": 0.65, "stormwater_m3": 0.03, "energy_kwh": 1.1, "particles_kg": 0.004}


def measures(df: DataFrame) -> DataFrame:
    """Canopy and greening gain, shade proxy, heat reduction and cost for each m2, with what is wrong in ``error``."""
    share = lambda c: F.col(c).between(0, 1)
    gain = F.col("projected_canopy_m2") - F.col("baseline_canopy_m2")
    problems = F.array_compact(F.array(
        F.when((F.col("baseline_canopy_m2") < 0) | (F.col("projected_canopy_m2") < 0), F.lit("negative_canopy")),
        F.when(~(F.col("baseline_greenery_pct").between(0, 100) & F.col("projected_greenery_pct").between(0, 100)), F.lit("greenery_out_of_bounds")),
        F.when(~(share("survival") & share("suitability") & share("overlap")), F.lit("factor_out_of_bounds")),
        F.when(F.col("total_cost") < 0, F.lit("negative_cost")),
    ))
    ok = F.size(problems) == 0
    return df.withColumns({
        "canopy_gain_m2": F.when(ok, gain), "greening_gain_pct": F.when(ok, F.col("projected_greenery_pct") - F.col("baseline_greenery_pct")),
        "shade_m2": F.when(ok, F.col("projected_canopy_m2") * F.col("survival") * F.col("suitability") * F.col("overlap")),
        "heat_reduction_c": F.when(ok, F.col("baseline_lst_c") - F.col("projected_lst_c")), "cost_per_m2": F.when(ok & (gain > 0), F.col("total_cost") / F.when(gain > 0, gain)),
        "error": F.array_join(problems, "; "),
    })


def heat_projection(df: DataFrame) -> DataFrame:
    """What may be shown of a heat projection: nothing, a range, or a point, by the model's status and precision."""
    shown = (F.col("model_status") == "validated") & (F.col("precision") != "suppressed")
    ranged, point = shown & (F.col("precision") == "indicative_range"), shown & (F.col("precision") == "precise_point_estimate")
    good = ranged & (F.col("cooling_min_c") >= 0) & (F.col("cooling_max_c") >= F.col("cooling_min_c"))
    return df.withColumns({
        "heat_status": F.when(ranged, F.when(good, "validated_indicative_range").otherwise("invalid_range"))
        .when(point, F.when(F.col("projected_lst_c").isNull(), "missing_point").otherwise("validated_model_output")).otherwise("indicative_model_not_validated"),
        "shown_min_c": F.when(good, F.col("cooling_min_c")), "shown_max_c": F.when(good, F.col("cooling_max_c")), "shown_reduction_c": F.when(point, F.col("baseline_lst_c") - F.col("projected_lst_c")),
    })


def community_totals(df: DataFrame, *by: str) -> DataFrame:
    bad = F.least("quantity", "area_m2", "minimum_cost", "maximum_cost") < 0
    return df.groupBy(*by).agg(
        F.sum("quantity").alias("quantity"), F.sum("area_m2").alias("area_m2"), F.sum("minimum_cost").alias("minimum_cost"), F.sum("maximum_cost").alias("maximum_cost"),
        F.count_if(bad | (F.col("maximum_cost") < F.col("minimum_cost"))).alias("n_invalid"),
    )


def impact(df: DataFrame) -> DataFrame:
    """Area and temperature ranges of scenarios with the EXAMPLE_SCHEMA columns and site_area_m2.

    The area is quantity, unit area, survival, suitability, and overlap or cover multiplied; its share of the
    site (or wall), held between 0 and 1, scales the evidence bound. Pots have no temperature effect.
    """
    pair = lambda name: ranges.of(F.col(f"{name}_min"), F.col(f"{name}_max"))
    unit = ranges.scale(pair("unit"), F.col("quantity"))
    area = ranges.multiply(unit, pair("survival"), pair("suitability"), pair("overlap"), pair("cover"))
    fractions = [ranges.valid(pair(n), True) for n in ("survival", "suitability", "overlap", "cover")]
    good = reduce(lambda a, b: a & b, fractions, ranges.valid(pair("unit"))) & (F.col("quantity") > 0) & ~((F.col("action") == "tree") & (F.col("quantity") > 1))
    base = F.when(F.col("action") == "green_wall", F.col("target_area_m2")).when(F.col("action") == "potted_plants", 1.0).otherwise(F.col("site_area_m2"))
    good = good & (base > 0)
    clamp = lambda x: F.least(F.greatest(x / F.when(base > 0, base), F.lit(0.0)), F.lit(1.0))
    bound = reduce(lambda rest, a: F.when(F.col("action") == a, F.lit(BOUNDS[a][1]).cast("double")).otherwise(rest), BOUNDS, F.lit(None).cast("double"))
    metric = reduce(lambda rest, a: F.when(F.col("action") == a, F.lit(BOUNDS[a][0]).cast("string")).otherwise(rest), BOUNDS, F.lit(None).cast("string"))
    kind = reduce(lambda rest, a: F.when(F.col("action") == a, AREA_TYPES[a]).otherwise(rest), AREA_TYPES, F.lit(None).cast("string"))
    return df.withColumns({
        "valid": F.coalesce(good, F.lit(False)), "area_type": kind,
        "area_min_m2": F.when(good, F.round(area["minimum"], 3)), "area_max_m2": F.when(good, F.round(area["maximum"], 3)),
        "cooling_min_c": F.when(good & bound.isNotNull(), F.round(F.lit(0.0) * clamp(area["minimum"]), 3)),
        "cooling_max_c": F.when(good, F.round(bound * clamp(area["maximum"]), 3)), "cooling_metric": F.when(good, metric),
    })


def grown_canopy(df: DataFrame) -> DataFrame:
    """Canopy range after some years from an initial range and a yearly growth range."""
    end = lambda s: F.col(f"initial_{s}") + F.col(f"growth_{s}") * F.col("years")
    return df.withColumns({"canopy_min_m2": end("min"), "canopy_max_m2": end("max")})


def action_costs(scenarios: DataFrame, costs: DataFrame) -> DataFrame:
    """Cost range of each scenario and priced option, at the option's unit: pieces, or square metres of bed and wall."""
    pairs = [(a, o) for a, options in COST_OPTIONS.items() for o in options]
    options = scenarios.sparkSession.createDataFrame(pairs, "action string, option_code string")
    pieces = F.col("action").isin("tree", "potted_plants")
    low = F.col("quantity") * F.when(pieces, 1.0).otherwise(F.col("unit_min"))
    high = F.col("quantity") * F.when(pieces, 1.0).otherwise(F.col("unit_max"))
    x = scenarios.join(options, "action").join(costs, "option_code")
    if "tree_type" in scenarios.columns and "cost_tree_type" in costs.columns:
        asked = F.lower(F.trim("tree_type"))
        x = x.where((F.col("action") != "tree") | asked.isNull() | (asked == "") | (F.lower(F.trim("cost_tree_type")) == asked))
    return x.withColumns({"minimum_cost_aud": F.round(low * F.col("minimum_cost"), 2), "maximum_cost_aud": F.round(high * F.col("maximum_cost"), 2)})


def output_checks(df: DataFrame) -> DataFrame:
    """Failures of a scenario's output, and PASS or FAIL."""
    bad = F.array_compact(F.array(
        F.when(~F.coalesce((F.col("area_min_m2") >= 0) & (F.col("area_max_m2") >= F.col("area_min_m2")), F.lit(False)), F.lit("bad_area_range")),
        F.when((F.col("action") == "potted_plants") & F.col("cooling_max_c").isNotNull(), F.lit("pots_with_cooling")),
        F.when((F.col("cooling_min_c") < 0) | (F.col("cooling_max_c") < F.col("cooling_min_c")), F.lit("bad_cooling_range")),
        F.when((F.col("action") == "green_wall") & (F.col("cooling_metric") != "wall_surface_temperature"), F.lit("wall_metric_lost")),
    ))
    return df.withColumns({"check_failures": F.array_join(bad, "; "), "status": F.when(F.size(bad) == 0, "PASS").otherwise("FAIL")})


def score_parcels(parcels: DataFrame) -> DataFrame:
    """Every parcel with every example action: its ranges and checks. The actions are a fixed small table."""
    actions = parcels.sparkSession.createDataFrame(list(EXAMPLES), EXAMPLE_SCHEMA)
    x = parcels.withColumnRenamed("area_m2", "site_area_m2").join(F.broadcast(actions), F.lit(True))
    return output_checks(impact(x))


def scenario_canopy(trees: DataFrame, area: str = "site_area_m2") -> DataFrame:
    """Crown area that each scenario adds, its share of the site and the points it adds to the baseline."""
    x = trees.groupBy("scenario_id").agg(F.sum(F.pi() * F.col("radius") * F.col("radius")).alias("added_m2"), F.max(area).alias("site"), F.max("baseline_pct").alias("baseline_pct"))
    added = F.col("added_m2") / F.col("site") * 100
    return x.select("scenario_id", F.round("added_m2", 2).alias("added_m2"), F.round(added, 2).alias("added_pct"), F.round(F.least(F.col("baseline_pct") + added, F.lit(100.0)), 2).alias("total_pct"))


def benefits(df: DataFrame, canopy: str = "added_m2") -> DataFrame:
    return df.withColumns({k: F.col(canopy) * v for k, v in BENEFITS.items()})


def compare_to_preferred(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """Each scenario's differences from its group's preferred one."""
    best = df.where("preferred").groupBy(group).agg(*(F.first(v).alias(f"_{v}") for v in values))
    x = df.join(best, group)
    return x.select(*df.columns, *((F.col(v) - F.col(f"_{v}")).alias(f"{v}_diff") for v in values))


def readiness(models: DataFrame, datasets: DataFrame) -> DataFrame:
    """For each model its needed data sets that are missing or unlicensed, and whether it may run."""
    x = models.select("model_code", F.explode("required").alias("dataset")).join(datasets, "dataset", "left")
    missing, unlicensed = F.col("available").isNull() | ~F.col("available"), F.coalesce(F.col("available"), F.lit(False)) & ~F.coalesce("licensed", F.lit(False))
    pick = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("dataset")))), ",")
    return x.groupBy("model_code").agg(pick(missing).alias("missing"), pick(unlicensed).alias("unlicensed"), F.count_if(missing | unlicensed).alias("n_blockers"), (F.count_if(missing | unlicensed) == 0).alias("ready"))


def validation_status(results: DataFrame) -> DataFrame:
    """A model is validated when every case of it passed."""
    return results.groupBy("model_code").agg(F.count("*").alias("n_cases"), F.count_if("passed").alias("n_passed"), F.when(F.every("passed"), "validated").otherwise("validation_in_progress").alias("status"))


def publishable_results(results: DataFrame, models: DataFrame, runs: DataFrame) -> DataFrame:
    """Results of completed runs of validated models with a precision that may be shown."""
    m = models.where("status = 'validated' and precision <> 'suppressed'").select("model_code")
    return results.join(runs.where("status = 'completed'").select("run_id", "model_code"), "run_id").join(m, "model_code", "left_semi")
