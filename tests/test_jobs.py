import datetime as dt

import pytest
from pyspark.sql import functions as F

from greenlake.operators import growth, property, species, versions
from greenlake.plans import jobs
from greenlake.sources import publish, readers, scratch


def one(spark, **columns):
    """One row with the given SQL expressions."""
    return spark.range(1).selectExpr(*(f"{v} AS `{k}`" for k, v in columns.items()))


def feeds(spark):
    point = {"longitude": "144.9D", "latitude": "-37.8D"}
    return {
        "boundary": one(spark, properties="map('GCCSA Code 2021', '2GMEL', 'name', 'Greater Melbourne', 'source_year', '2021')", geometry="'g'", measured_m2="5D"),
        "lga": one(spark, properties="map('LGA_CODE', '1', 'lga_name', 'Kew')", geometry="'g'"),
        "weather": one(spark, wmo="'9'", history_product="''", name="'a'", aifstime_utc="'20240101000000'", air_temp="'20'", apparent_t="'-'", rel_hum="'50'", wind_spd_kmh="'18'", rain_trace="'Trace'", lat="'-37'", lon="'145'"),
        "addresses": one(spark, properties="map('pfi', '1', 'ezi_address', '1 A ST')", **point),
        "properties": one(spark, properties="map('prop_pfi', '1', 'Shape__Area', '30')", geometry="'g'"),
        "trees": one(spark, properties="map('OBJECTID', '1', 'canopy_radius', '2', 'tree_height', '5')", **point),
        "named-trees": one(spark, properties="map('com_id', '1', 'common_name', 'Elm', 'longitude', '144.9', 'latitude', '-37.8')"),
        **{f"named-trees-{c}": one(spark, properties=f"map('{k}', 'Elm', 'Status', 'Existing')", **point) for c, k in {
            "brimbank": "Genus", "yarra": "common", "casey": "commonname", "hobsons_bay": "Genus", "wyndham": "tree_common", "port_phillip": "common", "manningham": "species", "glen_eira": "Common_Name"}.items()},
        "canopy": one(spark, observed_on="DATE '2024-01-01'", vegetation_type="'canopy'", vegetation_percentage="20D", confidence_score="90D", geometry_wkt="'g'"),
        "city-canopy": one(spark, properties="map('area', '10')", geometry="'g'", measured_m2="10D"),
        "vegetation-change": one(spark, properties="map('unique_id', '7', 'Tree Change', '3')", geometry="'g'", observed_from="DATE '2014-01-01'", observed_to="DATE '2018-01-01'").withColumns({f"{k}_change_pct_points": F.lit(None).cast("double") for k in ()}),
        "traits": one(spark, source_row_number="1", dataset_id="'d'", taxon_name="'Acer'", trait_name="'plant_height'", value="'3'"),
        "growth": one(spark, source_row_number="1", City="'A'", Species="'Acer'", Ttree="1", TRW="'0.5'", BAI="'1'"),
        "growth-climate": one(spark, City="'A'", Year="2000", **{c: "1D" for c in ("AP", "PDM", "PWM", "PDQ", "MTWM", "MAT", "MTCM", "IDM", "IP")}),
        "heat": one(spark, observed_on="DATE '2024-01-01'", heat_value="30D", source_scene_id="'s'", geometry_wkt="'g'", cloud_cover_pct="1D"),
        "hourly-climate": spark.range(24).selectExpr("TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS time", "-37.8D AS lat", "145D AS lon", "293.15D AS t2m", "0.001D AS tp", "0.25D AS swvl1", "1e6D AS ssrd", "3D AS u10", "4D AS v10"),
        "costs": one(spark, option_code="'garden_bed'", cost_context="'c'", cost_basis="'b'", minimum_cost="'1'", maximum_cost="'2'", currency="'AUD'", includes_installation="'true'", source_name="'s'", source_reference="'r'", source_url="'u'", valid_from="'2024-01-01'", valid_to="'2024-02-01'", last_verified_at="'2024-01-01'", confidence_level="'low'"),
    }


def test_every_job_keeps_a_good_row(spark, tmp_path):
    for name, rows in feeds(spark).items():
        facts, report = jobs.run_job(name, rows, "v1", out=str(tmp_path))
        said = [(r["rule_code"], r["failed"]) for r in report.collect() if r["failed"]]
        assert not said and facts.count() == 1 and facts.first()["version_id"] == "v1", (name, said)
    for version in ("v1", "v1", "v2"):
        jobs.run_job("weather", feeds(spark)["weather"], version, out=str(tmp_path))
    assert publish.read_published(spark, f"{tmp_path}/facts/weather").count() == 2
    assert publish.published_runs(spark, f"{tmp_path}/quality/weather").count() == 2


def test_jobs_with_more_inputs(spark):
    guidance = one(spark, source_row_number="1", source_name="'s'", publisher="'p'", lga_code="'1'", scientific_name="'Acer rubrum'", common_name="NULL", mature_size_class="'small'", guidance_status="'approved'", effective_from="DATE '2024-01-01'", effective_to="DATE '2025-01-01'",
                   source_url="'u'", licence="'l'", limitation="'x'", **{c: "CAST(NULL AS DOUBLE)" for c in ("mature_height_min_m", "mature_height_max_m", "mature_canopy_width_min_m", "mature_canopy_width_max_m", "minimum_planting_area_m2")})
    facts, report = jobs.run_job("council-guidance", guidance, "v1", lga=one(spark, lga_code="'1'"))
    assert facts.count() == 1
    pixels = spark.range(100).selectExpr("CAST(id % 10 AS DOUBLE) AS x", "CAST(id DIV 10 AS DOUBLE) AS y", "112 AS value", "2024 AS observed_year")
    facts, report = jobs.run_job("land-cover", pixels, "v1")
    assert facts.count() == 1 and facts.first()["dominant_level3_code"] == 112
    assert set(jobs.JOBS) == set(feeds(spark)) | {"council-guidance", "land-cover"}


def test_jobs_stay_within_the_boundary(spark):
    x = spark.createDataFrame([({"OBJECTID": "1"}, 144.9, -37.8), ({"OBJECTID": "2"}, 150.0, -33.0)], "properties map<string,string>, longitude double, latitude double")
    box = one(spark, xmin="300000D", ymin="5700000D", xmax="400000D", ymax="5900000D")
    facts, _ = jobs.run_job("trees", x, "v1", box)
    assert [r["source_tree_id"] for r in facts.collect()] == ["1"]


def test_source_problems(spark):
    cols = ", ".join(f"{c} string" for c in readers.SOURCE_KEYS)
    good = ("a", "n", "p", "u", "c", "v", "l", "open_confirmed")
    x = spark.createDataFrame([good, good, ("b", None, "p", "u", "c", "v", "l", "secret")], cols)
    assert sorted(tuple(r) for r in readers.source_problems(x).collect()) == [("a", "duplicate_key"), ("b", "missing:name"), ("b", "unsupported_licence_status")]
    assert [tuple(r) for r in readers.source_problems(x.where("false")).collect()] == [(None, "no_datasets")]


def test_predictions(spark):
    lines = spark.createDataFrame([("Quercus Robur", t, 50, 0.0, 0.5, 0.5, 0.6, 1.0, 0.7, 40.0) for t in ("canopy_m2", "dbh_cm")], growth.LINES)
    ask = spark.createDataFrame([(" quercus ROBUR ", 10.0, "m", None), ("quercus robur", 40.0, "S", None), ("quercus robur", 41.0, "S", None), ("quercus robur", float("nan"), "S", None), ("oak", 1.0, "S", None)], "species string, years double, size string, start_width_m double")
    got = {(r["years"], r["species"]): r for r in growth.predict(ask, lines).collect()}
    import math

    r = got[10.0, "quercus robur"]
    x = math.log(16)
    area = {k: math.exp(a + b * x) for k, a, b in (("p10", 0, 0.5), ("p50", 0.5, 0.6), ("p90", 1.0, 0.7))}
    assert all(r[f"canopy_m2_{k}"] == round(v, 1) and r[f"crown_width_m_{k}"] == round(2 * math.sqrt(v / math.pi), 1) for k, v in area.items())
    assert r["age"] == 15 and r["height_m_p50"] is None and r["dbh_cm_p50"] == round(area["p50"], 1)
    status = sorted(x["status"] for x in got.values())
    assert status == ["bad_years", "beyond_training_ages", "ok", "ok", "unknown_species"]


def test_lines_against_direct_search(spark):
    """The fitted lines have the least pinball loss over a fine grid around them."""
    import numpy as np

    rng = np.random.default_rng(4)
    age = rng.integers(0, 30, 300)
    value = np.exp(0.2 + 0.9 * np.log1p(age) + 0.3 * rng.standard_normal(300))
    df = spark.createDataFrame([("s", int(a), float(v)) for a, v in zip(age, value)], "species string, age int, canopy_m2 double")
    r = growth.fit_lines(df, "canopy_m2").first()
    x, y = np.log1p(age), np.round(np.log(value) * 64) / 64

    def loss(a, b, q):
        d = y - a - b * x
        return np.maximum(q * d, (q - 1) * d).sum()

    for k, q in growth.QUANTILES:
        a, b = r[f"{k}_a"], r[f"{k}_b"]
        best = min(loss(a + i * 0.01, b + j * 0.01, q) for i in range(-10, 11) for j in range(-10, 11))
        assert loss(a, b, q) <= best + 1e-2


def test_prefix_forms_meet_each_address_once(spark):
    a = spark.createDataFrame([(1, "1 ST KILDA ROAD", "Y", "p", 0.0, 0.0), (2, "1 STREET KILDA ROAD", "N", "p", 0.0, 0.0), (3, "12 A ST", "N", "p", 0.0, 0.0)], "address_id int, full_address string, is_primary string, parcel_id string, x double, y double")
    r = spark.createDataFrame([(1, "1 st kilda rd"), (2, "1"), (3, ""), (4, "12 A STREET")], "request_id int, request string")
    for most in (100, 0):
        got = sorted((x["request_id"], x["address_id"], x["exact"]) for x in property.address_matches(r, a, typed=True, most_requests=most).collect())
        assert got == [(1, 1, True), (1, 2, True), (2, 1, False), (2, 2, False), (2, 3, False)]


def test_nearest_has_no_nested_loop(spark):
    from greenlake.operators.spatial_join import nearest

    q, s = spark.range(50).selectExpr("id AS k", "CAST(id AS DOUBLE) AS x", "0D AS y"), spark.range(10).selectExpr("id AS site", "CAST(id * 5 AS DOUBLE) AS x", "1D AS y")
    plan = nearest(q, s, "k", "site")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    far = q.unionByName(spark.sql("SELECT 99 AS k, 1e6D AS x, 1e6D AS y"))
    got = {r["k"]: r["site"] for r in nearest(far, s, "k", "site", few=0, start=1.0).collect()}
    assert got == {r["k"]: r["site"] for r in nearest(far, s, "k", "site").collect()} and len(got) == 51
    assert nearest(q, s.where("false"), "k", "site").count() == 0


def test_prices_and_arrays(spark):
    costs = spark.createDataFrame([("backyard_tree_diy", "Acer rubrum", "S", "exact_listed_size_price", 5.0, 6.0), ("backyard_tree_diy", "Acer rubrum", "S", "unmapped", 1.0, 2.0)], "option_code string, botanical_name string, size_label string, size_price_status string, minimum_cost double, maximum_cost double")
    ask = spark.createDataFrame([("acer RUBRUM", "S", 3), ("acer rubrum", "L", 1), ("acer rubrum", "S", 0)], "species string, size string, quantity int")
    got = sorted((r["status"], r["total_min"]) for r in species.supply_projection(ask, species.sized_prices(costs)).collect())
    assert got == [("bad_quantity", None), ("no_price_of_this_size", None), ("priced", 15.0)]
    old, new = spark.createDataFrame([(None, "a", None)], "k int, a string, b string"), spark.createDataFrame([(None, "x", "y", 1)], "k int, a string, b string, n int")
    assert [tuple(r) for r in versions.fill_missing(old, new, ["k"], "n").collect()] == [(None, "a", "y")]


def test_scratch_needs_a_shared_folder_beyond_one_machine(spark, monkeypatch):
    assert "greenlake-" in scratch.scratch_path(spark, "a")
    x = scratch.written(spark.range(3), "x")
    assert x.count() == 3 and dt.date.today()

    class Elsewhere:
        master = "yarn"

        def getConf(self):
            return self

        def get(self, key):
            return None

    class Session:
        sparkContext = Elsewhere()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="checkpoint"):
        scratch.scratch_path(Session(), "a")
