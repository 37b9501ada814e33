import json

import pytest
from pyspark.sql import functions as F

from greenlake.sources import inventories, publish, readers


def features(spark, properties):
    return spark.createDataFrame([(properties, 144.9, -37.8)], "properties map<string,string>, longitude double, latitude double")


def test_councils(spark):
    b = inventories.normalise_council(features(spark, {"Genus": "Eucalyptus", "Species": "camaldulensis", "height": "10-15", "canopy": "5-10", "dbh": "40-60", "Status": "Existing"}), "brimbank").first()
    assert (b["active_record"], b["height_min_m"], b["canopy_width_max_m"], b["dbh_min_cm"], b["scientific_name"]) == (True, 10, 10, 40, "Eucalyptus camaldulensis")
    y = inventories.normalise_council(features(spark, {"ref": "Y1", "height": "8.5", "common": "Elm"}), "yarra").first()
    assert (y["source_tree_id"], y["height_m"], y["display_name"], y["taxonomic_precision"]) == ("yarra:Y1", 8.5, "Elm", "common_name")
    c = inventories.normalise_council(features(spark, {"commonname": "To Be Determined", "description": "Acacia sp.", "canopyewwidth_m": "4", "canopynswidth_m": "6", "assetnumber": "7", "address": "1 A St", "suburb": "Kew"}), "casey").first()
    assert (c["scientific_name"], c["taxonomic_precision"], c["canopy_width_m"], c["source_tree_id"], c["address"]) == ("Acacia sp.", "genus", 5, "casey:7", "1 A St Kew")
    h = inventories.normalise_council(features(spark, {"Genus": "Acacia", "Species": None, "dbh_mm": "100-200"}), "hobsons_bay").first()
    assert (h["dbh_min_cm"], h["dbh_max_cm"], h["taxonomic_precision"]) == (10, 20, "genus")
    pp = inventories.normalise_council(features(spark, {"species": "Ulmus minor", "planted": "2001-05-06", "ref": "3"}), "port_phillip").first()
    assert (pp["year_planted"], pp["genus"], pp["display_name"]) == (2001, "Ulmus", "Ulmus minor")
    all_ = inventories.normalise_councils({k: features(spark, {"species": "Ulmus minor"}) for k in inventories.COUNCILS})
    assert all_.columns == list(inventories.CONTRACT) and all_.count() == 3  # yarra, port_phillip and manningham read that field
    with pytest.raises(ValueError):
        inventories.normalise_council(features(spark, {"a": "b"}), "nowhere")


def test_station_json(spark, tmp_path):
    row = {"wmo": "95936", "name": "Melbourne (Olympic Park)", "aifstime_utc": "20260825090000", "air_temp": 20.5, "apparent_t": 19.1, "rel_hum": 55, "wind_spd_kmh": 18, "rain_trace": "Trace", "lat": -37.8255, "lon": 144.9816}
    (tmp_path / "a.json").write_text(json.dumps({"observations": {"data": [row]}}))
    r = inventories.normalise_weather(readers.read_station_json(spark, str(tmp_path / "a.json"))).first()
    assert (r["station_code"], r["wind_speed_ms"], r["rainfall_since_9am_mm"], str(r["observed_at"]), r["geometry_wkt"]) == ("95936", 5.0, 0.0, "2026-08-25 09:00:00", "POINT (144.9816 -37.8255)")
    (tmp_path / "b.json").write_text(json.dumps({"observations": {}}))
    with pytest.raises(Exception, match="missing"):
        readers.read_station_json(spark, str(tmp_path / "b.json")).collect()


def test_rings(spark):
    x = spark.createDataFrame([(2, "M", "Robinia pseudoacia", "1", 0.4, None), (3, "M", "Robinia pseudoacia", "1", 0.5, 0.2), (4, "M", "Ulmus parvifolia.", "2", 0.6, 0.3)], "source_row_number int, City string, Species string, Ttree string, TRW double, BAI double")
    got = [(r["species_name"], r["ring_sequence"]) for r in inventories.normalise_rings(x).orderBy("source_row_number").collect()]
    assert got == [("Robinia pseudoacacia", 1), ("Robinia pseudoacacia", 2), ("Ulmus parvifolia", 1)]


def test_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text("﻿a,b\n1, 2\n3,\n", encoding="utf-8")
    df = readers.read_csv(spark, str(tmp_path / "x.csv"), row_number="n")
    assert [r["n"] for r in df.collect()] == [2, 3] and df.columns[:2] == ["a", "b"]
    readers.write_json_lines(df, str(tmp_path / "out"))
    assert readers.read_json_lines(spark, str(tmp_path / "out"), "a string, b string").count() == 2
    d = readers.file_digests(spark, str(tmp_path / "x.csv")).first()
    assert len(d["sha256"]) == len(d["combined_sha256"]) == 64
    f = {"features": [{"properties": {"OBJECTID": "1", "canopy_radius": "99", "tree_height": "5"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}] * 2}
    (tmp_path / "f.json").write_text(json.dumps(f))
    x = readers.read_features(spark, str(tmp_path / "f.json")).withColumns({"longitude": F.lit(1.0), "latitude": F.lit(2.0)})
    t = inventories.normalise_urban_tree(x).collect()
    assert len(t) == 1 and t[0]["canopy_radius_m"] is None and t[0]["height_m"] == 5
    v = df.withColumn("version_id", F.lit("v1"))
    publish.publish(v, str(tmp_path / "facts"))
    publish.publish(v.withColumn("version_id", F.lit("v2")), str(tmp_path / "facts"))
    assert publish.read_published(spark, str(tmp_path / "facts")).count() == 4
    with pytest.raises(ValueError):
        readers.write_vector(df, str(tmp_path / "x.shp"))
    cube = readers.resolve_cube(spark.sql("SELECT 1D latitude, 2D longitude, timestamp'2024-01-01' valid_time, 280D t2m")).first()
    assert cube["lat"] == 1 and cube["t2m"] == 280 and cube["tp"] is None


def test_tiles(spark):
    t = inventories.tiles_of(spark, 0, 0, 25, 10, 10)
    assert t.count() == 3 and t.agg(F.max("xmax")).first()[0] == 25
    assert inventories.split_tiles(t).count() == 12


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_of_several_files_are_numbered_in_file_order(spark, tmp_path, multi_line):
    sizes = [3, 5000, 50]
    for i, n in enumerate(sizes):
        (tmp_path / f"{i}.csv").write_text("id,said\n" + "".join(f"{i}-{k},some words to fill the line\n" for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # the second file is read by several tasks
    try:
        rows = readers.read_csv(spark, str(tmp_path), "id string, said string", "row", multi_line).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    names = [f"{i}-{k}" for i, n in enumerate(sizes) for k in range(n)]
    assert sorted((r["row"], r["id"]) for r in rows) == [(k + 2, name) for k, name in enumerate(names)]


def test_features_by_lines_and_whole(spark, tmp_path):
    """A file of one feature a line is read by several tasks; files of any other form give the same rows."""
    one = lambda i: f'{{"type": "Feature", "properties": {{"a": "x,{i}", "n": {i}}}, "geometry": {{"type": "Point", "coordinates": [1.50, {i}]}}}}'
    many, two = [one(i) for i in range(20000)], one(20001) + ", " + one(20002)
    forms = {
        "lines": '{\n"type": "FeatureCollection",\n"name": "x",\n"features": [\n' + ",\n".join(many) + "\n]\n}\n",
        "one line": '{"type":"FeatureCollection","features":[' + one(20000) + "]}",
        "two a line": '{"type":"FeatureCollection","features":[\n' + two + "\n]}",
        "pretty": '{"type":"FeatureCollection","features":[\n{"type":"Feature",\n"properties":{"a":"x,20003","n":20003},"geometry":{"type":"Point",\n"coordinates":[1.50, 20003]}},null\n]}',
        "crlf": '{"type":"FeatureCollection","features":[\r\n' + one(20004) + "\r\n]}",
        "none": '{"type":"FeatureCollection","features":[\n]}',
    }
    for name, said in forms.items():
        (tmp_path / f"{name}.geojson").write_text(said, newline="")
    rows = readers.read_features(spark, str(tmp_path)).collect()
    found = sorted((int(r["properties"]["n"]), r["properties"]["a"], r["coordinates"]) for r in rows if r["properties"])
    assert found == [(i, f"x,{i}", f"[1.50, {i}]") for i in range(20005)] and len(rows) == 20006
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")
    try:
        assert readers.read_features(spark, str(tmp_path / "lines.geojson")).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_written_features_are_one_a_line(spark, tmp_path):
    """In every batch of a partition."""
    df = spark.range(25000).repartition(1).selectExpr("id", "1.5D AS longitude", "IF(id % 2 = 0, 2D, NULL) AS latitude")
    readers.write_features(df, str(tmp_path / "f"))
    (file,) = (tmp_path / "f").glob("part-*")
    text = file.read_text()
    assert len(json.loads(text)["features"]) == 25000
    assert [line[:1] for line in text.splitlines()[1:-1]] == ["{"] * 25000
    assert readers.read_features(spark, str(tmp_path / "f")).where("geometry_type = 'Point'").count() == 12500


def test_council_texts_are_cleaned_once(spark):
    """The filter of active, named trees takes no lookup of a property along."""
    x = inventories.normalise_councils({k: features(spark, {"ref": "1", "common": "Elm"}) for k in ("yarra", "brimbank")})
    plan = x.select("source_tree_id", "display_name", "height_m")._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "element_at" in line]
    assert [r["display_name"] for r in x.collect()] == ["Elm"]
