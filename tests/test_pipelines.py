import datetime as dt

import pytest
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.plans import pipelines
from greenlake.sources import inventories


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_ingest_and_clip(spark):
    x = spark.createDataFrame([("a", 1.0, 1.0), ("b", 5.0, 5.0), ("c", 50.0, 50.0)], "id string, x double, y double")
    box = spark.createDataFrame([(0.0, 0.0, 10.0, 10.0)], "xmin double, ymin double, xmax double, ymax double")
    rules = [{"code": "U", "type": "unique", "fields": ["id"]}]
    facts, report = pipelines.ingest(x, rules, "points", "v1", box)
    assert rows(facts, "id", "version_id") == [("a", "v1"), ("b", "v1")] and report.where("passed_gate").count() == 2
    again, _ = pipelines.ingest(x.unionByName(x), rules, "points", "v1", box)
    assert again.count() == 0
    kept, counts = pipelines.clip(x.withColumn("version_id", F.lit("v1")), box, "clip")
    assert rows(counts, "n_in", "n_out", "retention_pct") == [(3, 2, 66.67)]
    twice, more = pipelines.clip(kept, box, "clip")
    assert twice.count() == kept.count() and more.first()["n_excluded"] == 0
    assert pipelines.membership_evidence(kept, "point_inside").first()["pass_rate"] == 100


def test_heat_and_scheme(spark):
    d = dt.date(2024, 1, 1)
    h = spark.createDataFrame([(f"c{i}", d, float(20 + i), "s") for i in range(9)], "cell_id string, observed_on date, heat_value double, source_scene_id string")
    x, checks = pipelines.heat_baseline(h)
    assert checks.first()["overall_rate"] == 100
    scheme = pipelines.classification_scheme(x, ["heat_value"], "v1")
    bands = pipelines.by_scheme(x, scheme, "heat_value").groupBy("band").count().collect()
    assert {r["band"]: r["count"] for r in bands} == {"Low": 3, "Medium": 3, "High": 3}
    with pytest.raises(Exception, match="no samples"):
        pipelines.classification_scheme(x.where("false"), ["heat_value"], "v1").collect()


def test_parcel_canopy_build(spark):
    parcels = spark.createDataFrame([(i, i * 10.0, 0.0, i * 10.0 + 2, 2.0, 4.0) for i in range(3)], "parcel_id int, xmin double, ymin double, xmax double, ymax double, area_m2 double")
    pixels = spark.createDataFrame([(i * 10 + a, b, 1) for i in range(3) for a in (0.5, 1.5) for b in (0.5, 1.5)], "x double, y double, value int")
    done = spark.createDataFrame([(0, 100.0, 1.0, 25.0, "passed")], "parcel_id int, coverage_pct double, canopy_m2 double, canopy_pct double, status string")
    x, gate = pipelines.parcel_canopy_build(parcels, pixels, done, 1.0)
    assert rows(x, "parcel_id", "canopy_pct") == [(0, 25), (1, 100), (2, 100)] and gate.first()["publish"]


def test_versions_and_cases(spark):
    v = spark.createDataFrame([(1, "integrated"), (2, "integrated")], "version_id int, integration_status string")
    out = pipelines.close_superseded(v, spark.createDataFrame([(1, 2)], "partial int, complete int"))
    assert rows(out, "version_id", "integration_status", "superseded_by") == [(1, "retired", 2), (2, "integrated", None)]
    r = spark.createDataFrame([("a", "m", 1, 1, True), ("a", "m", 2, 2, False)], "case_code string, model_code string, run_at int, result_id int, passed boolean")
    assert rows(pipelines.latest_case_results(r), "result_id") == [(2,)]
    s = spark.createDataFrame([("inner",)], "zone string")
    assert rows(pipelines.coverage_gaps(s, "zone", ["inner", "outer"]), "missing") == [("outer",)]


def test_prepare_vector(spark):
    x = spark.range(2).select("id", F.when(F.col("id") == 0, geo.box_polygon(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0))).alias("polygon"))
    good, report = pipelines.prepare_vector(x)
    assert rows(good, "id", "area_m2", "xmax") == [(0, 4, 2)] and tuple(report.first()) == (2, 1, 0)


def test_more_normalisers(spark):
    f = spark.createDataFrame([({"LGA_Code": "1", "lga_name": "KEW", "com_id": "7", "common_name": "Elm", "pfi": " 9 ", "ezi_address": "1 A ST", "prop_pfi": "5", "Shape__Area": "12.5"}, 144.9, -37.8, "wkt")], "properties map<string,string>, longitude double, latitude double, geometry string")
    assert tuple(inventories.normalise_lga(f).first())[:4] == ("1", "1", "KEW", "KEW")
    assert inventories.normalise_melbourne_trees(f).first()["display_name"] == "Elm"
    assert tuple(inventories.normalise_address(f).select("source_address_id", "geometry_wkt").first()) == ("9", "POINT (144.9 -37.8)")
    assert tuple(inventories.normalise_parcel(f).select("source_parcel_id", "parcel_area_m2").first()) == ("5", 12.5)
    t = inventories.normalise_traits(spark.createDataFrame([("height", " 4.5 ", ""), ("height", "tall", "m")], "trait_name string, value string, unit string"))
    assert rows(t, "value_text", "value_numeric", "unit") == [("4.5", 4.5, None), ("tall", None, "m")]
    k, proxy = inventories.asset_source(F.lit("canopy_api_tile_mosaic"))
    lic = inventories.licence_name(F.lit("http://creativecommons.org/licenses/by/4.0/legalcode"))
    assert tuple(spark.range(1).select(k, proxy, lic).first()) == ("api_tile_proxy", True, "CC BY 4.0")
    g = inventories.registry_problems(spark.createDataFrame([("1", "a", "http://x", "urban"), ("1", "b", "http://y", "urban")], "station_code string, name string, url string, role string"), ["urban", "coast"], "http://x")
    assert sorted(r["problem"] for r in g.collect()) == ["repeated code", "role without a station", "unofficial address"]
    c = inventories.normalise_costs(spark.createDataFrame([("12.345", "", "true")], "minimum_cost string, valid_to string, includes_installation string")).first()
    assert (str(c[0]), c[1], c[2]) in (("12.35", None, True), ("12.34", None, True))
    ch = inventories.normalise_change(spark.createDataFrame([({"Tree Change": "1.5", "MMB Unique": "4"}, "g"), ({"a": "b"}, "g")], "properties map<string,string>, geometry string"), {"tree_change_pct_points": ("tree_change",)})
    assert rows(ch, "has_change_measure", "tree_change_pct_points") == [(False, None), (True, 1.5)]


def test_ingest_reads_its_source_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    x = spark.range(1000).selectExpr("CAST(id % 990 AS STRING) AS id", "CAST(id AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y").mapInPandas(counted, "id string, x double, y double")
    box = spark.createDataFrame([(0.0, 0.0, 500.0, 500.0)], "xmin double, ymin double, xmax double, ymax double")
    rules = [{"code": "U", "type": "unique", "fields": ["id"]}, {"code": "R", "type": "range", "field": "x", "maximum": 995}, {"code": "Q", "type": "required", "fields": ["id"]}]
    facts, report = pipelines.ingest(x, rules, "points", "v1", box)
    assert facts.count() == 491 and facts.where("x > 500").count() == 0
    assert {(r["rule_code"], r["failed"]) for r in report.collect()} == {("U", 20), ("R", 4), ("Q", 0), (None, 20)}
    assert seen.value == 1000
