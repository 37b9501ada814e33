import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from greenlake.operators import grid, growth, linkage, property, quality, raster, scenarios, spatial_join, species, versions, weather
from greenlake.operators.quality_rules import RULES


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


R3 = [{"code": "R", "type": "required", "fields": ["id", "value"]}, {"code": "U", "type": "unique", "fields": ["id"]}, {"code": "V", "type": "range", "field": "value", "minimum": 0, "maximum": 100}]


def report(spark, data, rules=R3, threshold=95.0):
    df = spark.createDataFrame(data, "id string, value string")
    return {r["rule_code"]: r for r in quality.validate(df, rules, "x", threshold).collect()}


def test_quality(spark):
    assert report(spark, [("a", "10"), ("b", "100")])[None]["passed_gate"]
    bad = report(spark, [("a", "10"), ("A ", "101"), ("", "50")])
    assert bad[None]["failed"] == 3 and bad["U"]["failed"] == 2 and bad[None]["pass_rate"] == 0
    assert not report(spark, [])[None]["passed_gate"]
    third = report(spark, [("a", "1"), ("", "1"), ("", "1")], R3[:1], 33.332)
    assert third[None]["pass_rate"] == 33.33 and third[None]["passed_gate"]
    with pytest.raises(ValueError):
        report(spark, [], [{"code": "X", "type": "odd"}])
    with pytest.raises(ValueError):
        report(spark, [], R3, 101)
    assert report(spark, [("a", "x"), ("b", None)], R3[2:])["V"]["failed"] == 2
    df = spark.createDataFrame([("a", "10"), ("b", "200"), ("c", "5")], "id string, value string")
    assert quality.gate(df, R3, 95).count() == 0 and quality.gate(df, R3, 60).count() == 2
    assert len(RULES) == 18 and sum(map(len, RULES.values())) > 80


def test_heat(spark):
    d = dt.date
    h = spark.createDataFrame([("A", d(2026, 8, 2), 20.0, "one"), ("A", d(2026, 8, 2), 24.0, "two"), ("A", d(2026, 7, 10), 8.0, "old"), ("B", d(2026, 8, 1), 1.0, "x")], "cell_id string, observed_on date, heat_value double, source_scene_id string")
    assert rows(grid.heat_mosaic(h), "cell_id", "heat_value", "n_values", "source_scene_ids", "spread") == [("A", 22, 2, ["one", "two"], 4), ("B", 1, 1, ["x"], 0)]


def test_daily_grid(spark):
    t = [(dt.datetime(2024, 1, 1, h), -37.8, 145.0, 293.15, 0.001, 0.25, 1e6, 3.0, 4.0) for h in range(24)]
    r = grid.daily_from_hourly(spark.createDataFrame(t, "ts timestamp, lat double, lon double, t2m double, tp double, swvl1 double, ssrd double, u10 double, v10 double")).first()
    assert abs(r["air_temperature_mean_c"] - 20) < 1e-9 and abs(r["precipitation_total_mm"] - 24) < 1e-9 and abs(r["surface_solar_radiation_total_mj_m2"] - 24) < 1e-9 and r["wind_speed_mean_ms"] == 5 and r["hour_count"] == 24


def test_climate_variants(spark):
    x = spark.createDataFrame([("M", 2000, 500), ("M", 2000, 500), ("M", 2000, 600)], "city string, year int, ap int")
    assert rows(grid.climate_variants(x, ["city", "year"], ["ap"]), "ap", "source_occurrence_count", "ambiguous") == [(500, 2, True), (600, 1, True)]


def test_versions(spark):
    v = spark.createDataFrame([(1, 1, "2024-01-01"), (2, 1, "2024-02-01"), (3, 2, "2024-01-01")], "version_id int, source_id int, extracted_at string")
    assert rows(versions.latest_version(v), "version_id") == [(2,), (3,)]
    a = versions.child_version(v, "clip")
    assert rows(a, "version_id") == rows(versions.child_version(v, "clip"), "version_id")
    done = a.limit(1).withColumn("status", F.lit("completed"))
    assert versions.child_version(v, "clip", done).count() == 2
    old, new = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string"), spark.createDataFrame([(None, "c"), (2, "d")], "k int, v string")
    assert sorted(rows(versions.upsert(old, new, ["k"]), "v")) == [("b",), ("c",), ("d",)]
    assert sorted(rows(versions.insert_absent(old, new, ["k"]), "v")) == [("a",), ("b",), ("d",)]


def test_nearest_by_buckets_equals_broadcast(spark):
    q = spark.range(40).selectExpr("id AS k", "CAST((id * 7919) % 60000 AS DOUBLE) AS x", "CAST((id * 104729) % 60000 AS DOUBLE) AS y")
    s = spark.range(25).selectExpr("id AS site", "CAST((id * 1511) % 60000 AS DOUBLE) AS x", "CAST((id * 2503) % 60000 AS DOUBLE) AS y")
    assert rows(spatial_join.nearest(q, s, "k", "site"), "k", "site") == rows(spatial_join.nearest(q, s, "k", "site", few=0), "k", "site")


def test_pixels_and_parcels(spark):
    p = spark.createDataFrame([("a", 0.0, 0.0, 2.0, 2.0, 4.0)], "parcel_id string, xmin double, ymin double, xmax double, ymax double, area_m2 double")
    full = spark.createDataFrame([(0.5, 0.5, 1), (1.5, 0.5, 1), (0.5, 1.5, 0), (1.5, 1.5, 0)], "x double, y double, value int")
    assert rows(raster.parcel_canopy(p, full, 1.0), "canopy_m2", "canopy_pct", "coverage_pct", "status") == [(2, 50, 100, "passed")]
    half = spark.createDataFrame([(0.5, 0.5, 1), (1.5, 0.5, 255), (0.5, 1.5, 0), (1.5, 1.5, 255)], "x double, y double, value int")
    assert rows(raster.parcel_canopy(p, half, 1.0), "canopy_m2", "canopy_pct", "coverage_pct", "status") == [(None, None, 50, "failed")]
    with pytest.raises(Exception, match="tree class"):
        raster.infer_tree_class(spark.createDataFrame([(3,)], "value int")).collect()
    lst = raster.decode_lst(spark.createDataFrame([(0, 0), (45000, 0), (45000, 8), (45000, 64), (65000, 0)], "dn int, qa int"))
    assert [r["lst_c"] for r in lst.collect()] == [pytest.approx(45000 * 0.00341802 + 149 - 273.15)] * 2


def test_radius_and_context(spark):
    c = spark.createDataFrame([(1, 0.0, 0.0)], "centre_id int, cx double, cy double")
    trees = spark.createDataFrame([("a", 5.0, 0.0), ("b", 10.0, 0.0), ("c", 15.0, 0.0), ("d", 2500.0, 0.0)], "id string, x double, y double")
    cells = spark.createDataFrame([("cell", -250.0, -250.0, 250.0, 250.0), ("far", 900.0, 900.0, 1200.0, 1200.0)], "id string, xmin double, ymin double, xmax double, ymax double")
    got = rows(property.environment_context(c, {"trees": trees, "heat": cells}, 1500.0, 2), "layer", "id", "rank")
    assert got == [("heat", "cell", 1), ("heat", "far", 2), ("trees", "a", 1), ("trees", "b", 2)]
    with pytest.raises(ValueError):
        property.environment_context(c, {}, 2001.0, 1)


def test_addresses(spark):
    a = spark.createDataFrame([(1, "A", "10 TEST STREET MELBOURNE 3000", "Y", 0.0, 0.0), (2, "B", "10 TEST ROAD MELBOURNE 3000", "N", 1.0, 1.0)], "address_id int, parcel_id string, full_address string, is_primary string, x double, y double")
    r = spark.createDataFrame([(1, "10 TEST"), (2, "10 Test Rd Melbourne"), (3, "99 none"), (4, "10")], "request_id int, request string")
    assert rows(property.resolve(r, a), "request_id", "status", "address_id") == [(1, "ambiguous", None), (2, "resolved", 2), (3, "no_match", None), (4, "ambiguous", None)]
    typed = property.autocomplete(spark.createDataFrame([(1, "10 test st")], "request_id int, request string"), a)
    assert rows(typed, "address_id", "rank") == [(1, 1)]
    assert rows(property.property_canopy(spark.createDataFrame([("A",), ("B",)], "parcel_id string"), spark.createDataFrame([("A", 25.0, "passed")], "parcel_id string, canopy_pct double, status string")), "parcel_id", "property_canopy_pct", "property_canopy_class") == [("A", 25, "Medium"), ("B", None, "Unavailable")]
    assert [r[0] for r in spark.range(1).select(property.geocoder_text(F.lit("1 High St, Kew, Victoria 3101, Australia"))).collect()] == ["1 HIGH ST KEW 3101"]


def test_weather(spark):
    now = dt.datetime(2024, 1, 1, 12)
    o = spark.createDataFrame([("1", now - dt.timedelta(minutes=30), 21.5, 0.0, 100.0), ("2", now - dt.timedelta(minutes=20), 19.0, 40000.0, 0.0), ("3", now - dt.timedelta(hours=4), 1.0, 0.0, 0.0)], "station_code string, observed_at timestamp, air_temperature_c double, x double, y double")
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 70000.0, 0.0)], "parcel_id int, x double, y double")
    got = rows(weather.nearest_recent(p, o, F.lit(now)), "parcel_id", "station_code", "context_status", "air_temperature_c", "age_minutes")
    assert got == [(1, "1", "good_local_context", 21.5, 30.0), (2, "2", "too_distant_temperature_suppressed", None, 20.0)]


def test_measures(spark):
    x = spark.createDataFrame([(25.0, 40.0, 18.5, 31.0, 0.9, 0.85, 0.95, 1200.0, 43.2, 40.7)], "baseline_canopy_m2 double, projected_canopy_m2 double, baseline_greenery_pct double, projected_greenery_pct double, survival double, suitability double, overlap double, total_cost double, baseline_lst_c double, projected_lst_c double")
    r = scenarios.measures(x).first()
    assert (r["canopy_gain_m2"], r["greening_gain_pct"], round(r["shade_m2"], 2), round(r["heat_reduction_c"], 2), r["cost_per_m2"], r["error"]) == (15, 12.5, 29.07, 2.5, 80, "")
    h = spark.createDataFrame([("prototype_only", "precise_point_estimate"), ("validated", "precise_point_estimate")], "model_status string, precision string").selectExpr("*", "40D baseline_lst_c", "38D projected_lst_c", "1D cooling_min_c", "2D cooling_max_c")
    assert rows(scenarios.heat_projection(h), "heat_status", "shown_reduction_c") == [("indicative_model_not_validated", None), ("validated_model_output", 2.0)]
    grown = scenarios.grown_canopy(spark.sql("SELECT 0D initial_min, 0D initial_max, 2.3D growth_min, 2.3D growth_max, 4 years")).first()
    assert abs(grown["canopy_max_m2"] - 9.2) < 1e-9
    s = scenarios.score_parcels(spark.sql("SELECT 1 parcel_id, 100D area_m2"))
    assert {r["action"]: (r["area_max_m2"], r["cooling_max_c"], r["status"]) for r in s.collect()} == {"tree": (43.7, 2.622, "PASS"), "potted_plants": (1.2, None, "PASS"), "garden_bed": (20, 1.2, "PASS"), "green_wall": (10, 15.5, "PASS")}


def test_species(spark):
    trees = spark.createDataFrame([("1", "City of Kew", "Acacia dealbata", "Wattle", 4.0)] * 3 + [("1", "City of Kew", None, "Elm", None)] + [("2", "City of Kew", "Quercus robur", "Oak", 9.0)], "lga_code string, municipality string, scientific_name string, common_name string, height_m double")
    lga = spark.createDataFrame([("1", "Kew City"), ("2", "Box Hill City")], "lga_code string, lga_name string")
    guide = spark.createDataFrame([("1", "Acacia dealbata", None, "recommended"), ("1", None, "Elm", "not_recommended")], "lga_code string, scientific_name string, common_name string, guidance_status string")
    got = {(r["lga_code"], r["species_key"]): r for r in species.popularity(trees, lga, guide).collect()}
    assert got["1", "scientific:acacia dealbata"]["popularity_rank"] == 1 and got["1", "scientific:acacia dealbata"]["share_pct"] == 75 and got["1", "scientific:acacia dealbata"]["list_category"] == "available_now"
    assert got["1", "common:elm"]["list_category"] == "not_recommended"
    assert got["2", "scientific:acacia dealbata"]["status"].startswith("fallback") and len([k for k in got if k[0] == "2"]) == 3
    empty = species.popularity(trees.where("false"), lga).collect()
    assert {r["status"] for r in empty} == {"unavailable_no_integrated_council_inventory"} and len(empty) == 2
    ok = spark.createDataFrame([("Acacia dealbata",), ("Acacia sp.",), ("Dead stump",), ("Ulmus cv",), ("A, b",)], "n string").select("n", species.resolved_identity("n").alias("k"))
    assert {r["n"] for r in ok.collect() if r["k"]} == {"Acacia dealbata"}


def test_growth(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    data = [(f"s{k}", f"t{k}-{i}", int(a), float(np.exp(0.3 + 0.8 * np.log1p(a) + 0.2 * rng.standard_normal()))) for k in range(2) for i, a in enumerate(rng.integers(0, 40, 400))]
    data += [("few", f"f{i}", i, 1.0) for i in range(5)]
    df = spark.createDataFrame(data, "species string, id string, age int, canopy_m2 double")
    lines = growth.fit_lines(df, "canopy_m2")
    got = {r["species"]: r for r in lines.collect()}
    assert set(got) == {"s0", "s1"}
    for s, r in got.items():
        x = np.array([(math.log1p(a), math.log(v)) for k, _, a, v in data if k == s])
        for name, q in growth.QUANTILES:
            below = np.mean(x[:, 1] < r[f"{name}_a"] + r[f"{name}_b"] * x[:, 0])
            assert abs(below - q) < 0.03
    parts = growth.split(df, "id").groupBy("species", "is_train").count().collect()
    assert {(r["species"], r["is_train"]): r["count"] for r in parts}["s0", True] == 320
    ask = spark.createDataFrame([("S0 ", 5.0, "M", None), ("s0", 5.0, None, 2.0), ("s9", 1.0, "S", None), ("s0", -1.0, "S", None), ("s0", 1.0, None, None), ("s0", 90.0, "S", None), ("s0", 1.0, "X", None)], "species string, years double, size string, start_width_m double")
    status = [r["status"] for r in growth.predict(ask, lines).collect()]
    assert status.count("ok") == 2 and {"unknown_species", "bad_years", "not_one_of_size_and_width", "beyond_training_ages", "unknown_size"} <= set(status)
    m = spark.createDataFrame([("1", "Mature", 4.0, 5.0, None, "A b", 1), ("1", "Mature", 6.0, 5.0, None, "A b", 2), ("2", "Young", 4.0, 5.0, None, "A b", 3), ("3", "Over mature", 9.0, None, 40.0, None, 4), ("3", "Over mature", 9.0, None, 40.0, "C d", 5)], "source_tree_id string, age_description string, canopy_width_m double, height_m double, dbh_cm double, scientific_name string, row_number int")
    assert rows(growth.mature_rows(m), "source_tree_id", "width_m") == [("1", 4.0), ("3", 9.0)]
    gain = spark.sql("SELECT 2D a, 4D b").select(growth.added_area("a", "b"), growth.added_area("b", "a")).first()
    assert tuple(gain) == (pytest.approx(3 * math.pi), 0)


def test_mature_width_model(spark):
    x = spark.range(600).selectExpr("CAST(id AS STRING) AS source_tree_id", "concat('sp', id % 15) AS species", "CAST(3 + id % 20 AS DOUBLE) AS height_m", "CAST(10 + id % 20 AS DOUBLE) AS dbh_cm", "(3 + id % 20) * 0.5D AS width_m")
    _, scores = growth.mature_width_model(x, ["height_m", "dbh_cm"], iterations=5)
    assert scores["seen_r2"] > 0.8


def test_linkage(spark):
    r = spark.range(1).select(linkage.binomials(F.lit("Tree Acacia dealbata near Ulmus minor")), linkage.hybrid_name(F.lit("Platanus x acerifolia")), linkage.clean_https(F.lit("http://a")), linkage.strip_markup(F.lit("<b>x</b>  y")), linkage.image_score(F.lit("whole tree leaf"), F.lit(True))).first()
    assert tuple(r) == (["Acacia dealbata", "Ulmus minor"], "Platanus × acerifolia", "https://a", "x y", 300 + 160 - 120)
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "source string, target string")
    assert rows(linkage.resolve_redirects(links), "source", "final") == [("a", "c"), ("b", "c"), ("x", "y")]


def test_width_model_stops_early_and_keeps_whole_species_out(spark):
    x = spark.range(900).selectExpr("CAST(id AS STRING) AS source_tree_id", "concat('sp', id % 30) AS species", "CAST(id DIV 30 % 3 AS DOUBLE) AS height_m", "CAST(id DIV 30 % 3 AS DOUBLE) AS width_m")
    model, scores = growth.mature_width_model(x, ["height_m"], iterations=30)
    assert scores["trees"] < 30 and scores["seen_r2"] > 0.99 and scores["unseen_r2"] > 0.99
    _, none = growth.mature_width_model(x.where("species in ('sp1', 'sp2', 'sp3', 'sp5', 'sp6')").withColumn("species", F.lit("sp1")), ["height_m"], iterations=2)
    assert none["unseen_r2"] is None or none["seen_r2"] is None


def test_lines_of_every_target(spark):
    spread = "element_at(array(0.6D, 0.8D, 1D, 1.25D, 1.6D), CAST(id % 5 + 1 AS INT))"
    x = spark.range(400).selectExpr("concat('s', id % 2) AS species", "CAST(id DIV 10 % 40 AS INT) AS age", f"pow(id DIV 10 % 40 + 1, 1.2D) * {spread} AS canopy_m2", f"pow(id DIV 10 % 40 + 1, 0.6D) * {spread} AS height_m")
    lines = growth.fit_all_lines(x).collect()
    assert {(r["species"], r["target"]) for r in lines} == {(s, t) for s in ("s0", "s1") for t in ("canopy_m2", "height_m")}
    assert all(abs(r["p50_b"] - {"canopy_m2": 1.2, "height_m": 0.6}[r["target"]]) < 0.1 and r["n"] == 200 for r in lines)


def test_valid_raster_sources(spark):
    rows = [(1, "analytical", 1, True, 2.0), (2, "analytical", 1, True, 2.1), (3, "visual", 1, True, 1.0), (4, "analytical", 3, True, 1.0), (5, "analytical", 1, False, 1.0), (6, "analytical", 1, True, None), (7, None, 1, True, 1.0), (8, "analytical", 1, True, 0.0)]
    assets = spark.createDataFrame(rows, "k int, role string, bands int, projected boolean, pixel_m double")
    assert [r["k"] for r in raster.valid_sources(assets).collect()] == [1]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Australia/Melbourne"])
def test_rows_in_force_today_in_melbourne(spark, zone):
    import datetime as dt
    from zoneinfo import ZoneInfo

    today = dt.datetime.now(ZoneInfo("Australia/Melbourne")).date()
    day = dt.timedelta(days=1)
    x = spark.createDataFrame([(1, today, today), (2, today + day, None), (3, None, today - day), (4, None, None)], "k int, valid_from date, valid_to date")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows(versions.current(x), "k") == [(1,), (4,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0, None, 2.0, float("nan")], [float(i * 37 % 101) for i in range(500)], [7.0] * 40 + [8.0] * 20, [0.0, 1.0]])
def test_percentiles_over_ranges(spark, values):
    """As the engine's own, of which one task holds all values; here none does."""
    x, shares = spark.createDataFrame([(v,) for v in values], "v double").repartition(3), [0.0, 1 / 3, 0.5, 2 / 3, 1.0]
    got = grid.percentiles(x, "v", shares)
    want = x.agg(*(F.percentile("v", F.lit(q)) for q in shares), F.count("v")).first()
    assert str(tuple(got.first())) == str(tuple(want))
    assert "percentile(" not in grid.tercile_thresholds(x, "v")._jdf.queryExecution().analyzed().toString().replace("percentiles", "")
