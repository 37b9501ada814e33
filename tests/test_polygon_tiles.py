import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.operators import polygon_tiles, spatial_join


def holds(rings, x, y):
    """Even-odd rule over whole rings, the boundary inside."""
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            odd ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return odd


def in_square(tile, x, y):
    """The same over a tile's sides, parity and turns."""
    tx, ty, size, inside, sides, odd, turns = tile
    if not (tx <= x < tx + size and ty <= y < ty + size):
        return False
    n = int(odd) + sum(t > y for t in turns)
    for ax, ay, bx, by in sides:
        if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        n += (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return inside or n % 2 == 1


def star(rnd, cx, cy, radius, corners):
    import math

    pts = [(cx + round(radius * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * i / corners)), cy + round(radius * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * i / corners))) for i in range(corners)]
    return [*pts, pts[0]]


point = st.tuples(st.integers(-6, 6), st.integers(-6, 6))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(point, min_size=2, max_size=7), min_size=1, max_size=3), st.sampled_from([1.0, 2.0, 4.0, 16.0]), st.integers(0, 3), st.integers(0, 3))
def test_squares_answer_as_the_whole_polygon(rings, size, few, halvings):
    rings = [[*r, r[0]] for r in rings]
    tiles = list(polygon_tiles.squares([[{"x": x, "y": y} for x, y in r] for r in rings], size, few, halvings))
    for x2 in range(-14, 15):
        for y2 in range(-14, 15):
            hits = [t for t in tiles if in_square(t, x2 / 2, y2 / 2)]
            assert len(hits) == holds(rings, x2 / 2, y2 / 2)


def as_polygon(rings):
    return [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]


def test_index_bounds_the_work(spark):
    rnd = random.Random(5)
    ring = star(rnd, 50_000, 50_000, 40_000, 4000)
    tiles = list(polygon_tiles.squares(as_polygon([ring]), 1000.0, 16, 3))
    sides = sum(len(t[4]) for t in tiles)
    assert any(t[3] and t[2] > 1000 for t in tiles)  # whole squares larger than a bucket
    assert sides < 40 * len(ring) and sum(len(t[6]) for t in tiles) <= 2 * sides


@pytest.mark.parametrize("size", [500.0, 3000.0])
def test_points_in_concave_polygons_with_holes(spark, size):
    rnd = random.Random(8)
    areas = [(i, [star(rnd, 5000 + 3000 * (i % 3), 4000 + 2500 * (i // 3), 3000, 60), star(rnd, 5000 + 3000 * (i % 3), 4000 + 2500 * (i // 3), 700, 9)]) for i in range(6)]
    points = [(k, rnd.randrange(0, 16000), rnd.randrange(0, 14000)) for k in range(1500)] + [(1500 + k, *areas[k % 6][1][k % 2][k % 9]) for k in range(36)] + [(9000, None, 5), (9001, 5000, None)]
    schema = f"area_id long, polygon {geo.POLYGON}"
    a = spark.createDataFrame([(i, as_polygon(p)) for i, p in areas] + [(7, None), (8, []), (9, [[]])], schema)
    p = spark.createDataFrame(points, "point_id long, x long, y long")
    want = {(k, i) for k, x, y in points if x is not None and y is not None for i, rings in areas if holds(rings, x, y)}
    got = spatial_join.points_in_areas(p, a, "inner", size, "polygon")
    assert "polygon" not in got.columns
    assert sorted((r["point_id"], r["area_id"]) for r in got.collect()) == sorted(want)
    semi = spatial_join.points_in_areas(p, a, "left_semi", size, "polygon")
    assert sorted(r["point_id"] for r in semi.collect()) == sorted({k for k, _ in want})
    anti = spatial_join.points_in_areas(p, a, "left_anti", size, "polygon")
    assert {r["point_id"] for r in anti.collect()} == {k for k, _, _ in points} - {k for k, _ in want}
    counts = {r["area_id"]: r["n"] for r in spatial_join.count_in_areas(a, p, "area_id", "n", size, "polygon").collect()}
    assert counts == {i: sum(j == i for _, j in want) for i in range(10) if i != 6}


def test_clipped_tiles_add_up_to_the_polygon(spark):
    rnd = random.Random(2)
    rings = [star(rnd, 3000, 3000, 2500, 40), star(rnd, 3000, 3000, 300, 5)]
    a = spark.createDataFrame([(1, as_polygon(rings))], f"area_id long, polygon {geo.POLYGON}")
    tiles = polygon_tiles.clipped(polygon_tiles.polygon_tiles(a, "polygon", 500.0), a, "polygon", "area_id")
    total = tiles.agg(F.sum("tile_area_m2")).first()[0]
    whole = a.select(geo.polygon_area(F.col("polygon"))).first()[0]
    assert total == pytest.approx(whole, rel=1e-9)


def test_polygons_that_meet_an_index(spark):
    rnd = random.Random(4)
    outer, hole = star(rnd, 6000, 6000, 4000, 80), [(5500, 5500), (6500, 5500), (6500, 6500), (5500, 6500), (5500, 5500)]
    area = spark.createDataFrame([(1, as_polygon([outer, hole]))], f"area_id long, polygon {geo.POLYGON}")
    box = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
    boxes = [box(rnd.randrange(0, 12000), rnd.randrange(0, 12000), rnd.choice([20, 300, 900])) for _ in range(250)]
    boxes += [box(0, 0, 20000), box(5700, 5700, 100), box(5400, 5400, 2000), box(6500, 6000, 5), box(19000, 0, 10)]
    left = spark.createDataFrame([(k, as_polygon([b])) for k, b in enumerate(boxes)], f"k long, polygon {geo.POLYGON}").withColumns(geo.bounds(F.col("polygon")))
    got = {r["k"] for r in spatial_join.areas_meet(left, area, size=700.0, polygons=("polygon", "polygon")).collect()}
    whole = left.withColumnRenamed("polygon", "p").join(area).where(geo.polygons_meet(F.col("p"), F.col("polygon")))
    assert got == {r["k"] for r in whole.collect()}
    assert {250, 252, 253} <= got and not {251, 254} & got
