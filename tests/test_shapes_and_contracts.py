import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.operators import canopy_ledger, contracts, spatial_join
from greenlake.plans import pipelines
from greenlake.sources import publish

POLYGONS = f"k long, polygon {geo.POLYGON}"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def test_projection_round_trip(spark):
    p = spark.createDataFrame([(lon / 10, lat / 10) for lon in range(1410, 1500, 7) for lat in range(-395, -335, 7)], "lon double, lat double")
    x, y = geo.to_map_grid("lon", "lat")
    lon, lat = geo.from_map_grid("x", "y")
    off = p.withColumns({"x": x, "y": y}).withColumns({"a": F.abs(lon - F.col("lon")), "b": F.abs(lat - F.col("lat"))}).agg(F.max("a"), F.max("b")).first()
    assert max(off) < 1e-8  # a millimetre


def test_tidied_rings(spark):
    rows = [
        (1, [ring((0, 0), (4, 0), (4, 4))]), (2, [ring((0, 0), (0, 0), (4, 0), (4, 4), (4, 4), (0, 0))]), (3, [ring((0, 0), (4, 0), (9, 0), (4, 0), (4, 4), (0, 0))]),
        (4, [ring((0, 0), (4, 0), (4, 4), (0, 0)), ring((1, 1), (1, 1))]), (5, [ring()]), (6, None), (7, []),
    ]
    x = spark.createDataFrame(rows, POLYGONS).withColumn("t", geo.tidied(F.col("polygon")))
    got = {r["k"]: r["t"] and [[(p["x"], p["y"]) for p in g] for g in r["t"]] for r in x.collect()}
    plain = [(0, 0), (4, 0), (4, 4), (0, 0)]
    assert got == {1: [plain], 2: [plain], 3: [plain], 4: [plain], 5: [[]], 6: None, 7: []}


def test_crossing_sides_are_found(spark):
    rnd = random.Random(1)
    rows = [
        (1, [ring((0, 0), (4, 4), (4, 0), (0, 4), (0, 0))]), (2, [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))]), (3, [ring((0, 0), (9, 0), (9, 9), (0, 9), (0, 0)), ring((8, 1), (10, 1), (8, 3), (8, 1))]),
        (4, [ring((0, 0), (9, 0), (4, 0), (4, 4), (0, 0))]), (5, [ring((0, 0), (4, 0), (4, 2), (2, 0), (0, 2), (0, 0))]),
    ]
    for k in range(10, 40):
        pts = [(rnd.randrange(0, 40), rnd.randrange(0, 40)) for _ in range(rnd.randrange(3, 9))]
        rows.append((k, [ring(*dict.fromkeys(pts), pts[0])]))

    def hand(a, b, c):
        return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])

    def on(a, b, p):
        return hand(a, b, p) == 0 and min(a["x"], b["x"]) <= p["x"] <= max(a["x"], b["x"]) and min(a["y"], b["y"]) <= p["y"] <= max(a["y"], b["y"])

    def crosses(rings):
        s = [(i, j, r[j], r[j + 1], len(r) - 1) for i, r in enumerate(rings) for j in range(len(r) - 1)]
        for n, (i, j, a, b, size) in enumerate(s):
            for k, m, c, d, _ in s[n + 1 :]:
                if i == k and m == j + 1:
                    hit = on(a, b, d) or on(c, d, a)
                elif i == k and j == 0 and m == size - 1:
                    hit = on(a, b, c) or on(c, d, b)
                else:
                    hit = (hand(a, b, c) * hand(a, b, d) < 0 and hand(c, d, a) * hand(c, d, b) < 0) or on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)
                if hit:
                    return True
        return False

    got = {r["k"] for r in spatial_join.self_crossings(spark.createDataFrame(rows, POLYGONS), "k", "polygon").collect()}
    assert got == {k for k, rings in rows if crosses(rings)} and {1, 3, 4, 5} <= got and 2 not in got


def test_prepared_from_degrees(spark):
    square = ring((145.0, -37.0), (145.01, -37.0), (145.01, -36.99), (145.0, -36.99))
    bow = ring((145.0, -37.0), (145.01, -36.99), (145.01, -37.0), (145.0, -36.99), (145.0, -37.0))
    x = spark.createDataFrame([(1, [square]), (2, [bow]), (3, None), (4, [ring((1, 1), (2, 2))])], POLYGONS)
    good, report = pipelines.prepare_vector(x, key="k", degrees=True)
    rows = good.collect()
    assert [r["k"] for r in rows] == [1] and rows[0]["repaired"] and 980_000 < rows[0]["area_m2"] < 990_000
    assert report.first().asDict() == {"n_in": 4, "n_null": 1, "n_invalid": 1, "n_crossed": 1, "n_repaired": 1}


def test_half_runs_equal_one_run(spark, tmp_path):
    rnd = random.Random(6)
    rows = [(i % 5, float(rnd.randrange(0, 40)), float(rnd.randrange(0, 40)), rnd.choice([0, 1, 1, 255])) for i in range(3000)]
    pixels = spark.createDataFrame(rows, "tile_id long, x double, y double, value int")
    tiles = spark.createDataFrame([(i, f"d{i}") for i in range(5)] + [(9, "no pixels")], "tile_id long, sha256 string")
    shown = lambda t, b, of=tiles: sorted(map(tuple, canopy_ledger.merged(spark, t, b, of, 10.0).collect()))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    build = canopy_ledger.add_tiles(one, tiles, pixels, 10.0)
    assert canopy_ledger.add_tiles(two, tiles, pixels, 10.0, only=tiles.where("tile_id < 2")) == build
    assert shown(two, build) == []  # not all are in
    # Done tiles are not read again: other pixels of theirs change nothing.
    changed = pixels.withColumn("value", F.when(F.col("tile_id") < 2, 0).otherwise(F.col("value")))
    for _ in range(2):
        canopy_ledger.add_tiles(two, tiles, changed, 10.0)
    assert shown(one, build) == shown(two, build) != []
    assert publish.manifest(spark, two)["number"] == 2
    for cx, cy, pct, _, n in shown(one, build):
        mine = [(t, v) for t, x, y, v in rows if v != 255 and x // 10 == cx and y // 10 == cy]
        assert pct == pytest.approx(100 * sum(v for _, v in mine) / len(mine), abs=0.006) and n == len({t for t, _ in mine})
    other = tiles.withColumn("sha256", F.concat("sha256", F.lit("x")))
    new = canopy_ledger.fingerprint(other, size=10.0, tree_value=1)
    assert new != build and shown(one, new, other) == []  # another digest shares nothing


def differences(actual, expected, path=()):
    """Failures of an expected object that is to be a part of the actual one."""
    at = ".".join(path)
    if isinstance(expected, dict):
        if not isinstance(actual, dict):
            return [f"{at}:object"]
        return [f for k, v in expected.items() for f in (differences(actual[k], v, (*path, k)) if k in actual else [".".join((*path, k)) + ":missing"])]
    if isinstance(expected, (int, float)) and not isinstance(expected, bool):
        if isinstance(actual, bool):
            return [f"{at}:number"]
        try:
            return [] if abs(float(actual) - expected) <= 0.001 else [f"{at}:number"]
        except (TypeError, ValueError):
            return [f"{at}:number"]
    return [] if type(actual) is type(expected) and actual == expected else [f"{at}:value"]


values = st.recursive(
    st.sampled_from([None, True, False, 1, 2, 1.0005, "a", "2", [1, 2], [], {}]), lambda inner: st.dictionaries(st.sampled_from(["a", "b", "c.d"]), inner, max_size=3), max_leaves=6
)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(values, values), min_size=60, max_size=60))
def test_nested_cases_against_a_walk(spark, pairs):
    pairs = pairs + [(a, a) for a, _ in pairs]
    table = lambda k: spark.createDataFrame([(i, json.dumps(p[k])) for i, p in enumerate(pairs)], "case_code long, answer string")
    got = {r["case_code"]: r["failures"] for r in contracts.compare_nested(table(0), table(1), "case_code", "answer").collect()}
    assert got == {i: ",".join(sorted(differences(a, e))) for i, (a, e) in enumerate(pairs)}


def test_cases_without_an_answer(spark):
    table = lambda rows: spark.createDataFrame(rows, "c long, j string")
    got = contracts.compare_nested(table([(1, None), (2, "{broken")]), table([(1, "{}"), (2, '{"a": 1}'), (3, "1")]), "c", "j").collect()
    assert {r["c"]: (r["failures"], r["passed"]) for r in got} == {1: (":missing", False), 2: (":missing", False), 3: (":missing", False)}


@pytest.mark.parametrize("of", [geo.interior_point, geo.valid_polygon, geo.polygon_area, lambda p: geo.in_polygon(p, geo.polygon_area(p), F.lit(0)), lambda p: geo.ring_area(geo.clip_to_convex(p[0], geo.box_polygon(F.lit(0), F.lit(0), F.lit(1), F.lit(1))[0]))])
def test_polygons_are_made_once(spark, of):
    """An expression names its polygon a few times at most, however often it uses it, and a place it is asked about once."""
    df = spark.range(1).select(geo.box_polygon(F.col("id"), F.lit(0), F.lit(2), F.lit(2)).alias("polygon")).select(of(F.col("polygon")).alias("x"))
    assert df._jdf.queryExecution().analyzed().toString().splitlines()[0].count("polygon#") <= 2
    assert df.first()["x"] is not None
