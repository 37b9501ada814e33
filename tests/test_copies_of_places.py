"""Points of one place and areas of one shape are met once, whatever the number of their copies."""

import pytest
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.operators import raster, spatial_join
from greenlake.plans import pipelines


def copies(spark):
    # 3 shapes with 30 copies each and 4 places with 50 points each; the last place lies in no shape, one shape is empty.
    areas = spark.range(90).selectExpr("id AS parcel_id", "id % 3 * 100 AS xmin", "0L AS ymin", "id % 3 * 100 + 10 AS xmax", "10L AS ymax", "100L AS area_m2")
    points = spark.range(200).selectExpr("id AS p", "element_at(array(0L, 5L, 110L, 900L), CAST(id % 4 AS INT) + 1) AS x", "5L AS y", "1D AS radius", "CAST(id % 8 = 0 AS INT) AS value")
    return areas, points


@pytest.mark.parametrize("polygon", [None, "polygon"])
def test_sums_and_counts(spark, polygon, monkeypatch):
    areas, points = copies(spark)
    areas = areas.withColumn("polygon", geo.box_polygon("xmin", "ymin", "xmax", "ymax"))
    met, real = [], spatial_join.points_in_areas
    monkeypatch.setattr(spatial_join, "points_in_areas", lambda p, a, *rest: met.append((p.count(), a.count())) or real(p, a, *rest))
    got = {r["parcel_id"]: r["n"] for r in spatial_join.count_in_areas(areas, points, "parcel_id", "n", polygon=polygon).collect()}
    assert got == {i: (100, 50, 0)[i % 3] for i in range(90)}
    sums = spatial_join.sums_in_areas(areas, points, "parcel_id", {"n": F.lit(1), "v": F.col("value")}, polygon=polygon)
    assert {r["parcel_id"]: (r["n"], r["v"]) for r in sums.collect()} == {i: ((100, 25), (50, 0))[i % 3] for i in range(90) if i % 3 < 2}
    assert met == [(4, 3), (4, 3)]


def test_an_area_of_two_rows(spark):
    areas = spark.createDataFrame([(1, 0, 0, 10, 10), (1, 50, 0, 60, 10), (2, 0, 0, 10, 10), (3, None, 0, 1, 1)], "k int, xmin int, ymin int, xmax int, ymax int")
    points = spark.createDataFrame([(5, 5), (5, 5), (55, 5), (None, 5)], "x int, y int")
    assert sorted(map(tuple, spatial_join.sums_in_areas(areas, points, "k", {"n": F.lit(1)}).collect())) == [(1, 3), (2, 2)]


def test_canopy_of_copies(spark):
    areas, points = copies(spark)
    got = {r["parcel_id"]: (r["coverage_pct"], r["canopy_m2"]) for r in raster.parcel_canopy(areas, points, 1.0).collect()}
    assert got == {i: ((100.0, 25.0), (50.0, None), (0.0, None))[i % 3] for i in range(90)}
    lots = {r["parcel_id"]: (r["n_trees"], r["crown_pct"]) for r in pipelines.lot_canopy(areas, points).collect()}
    assert lots == {i: ((100, 314.16), (50, 157.08), (0, 0.0))[i % 3] for i in range(90)}


@pytest.mark.parametrize("few", [0, 100])
def test_hit_once(spark, few, monkeypatch):
    monkeypatch.setattr(spatial_join, "FEW_PLACES", few)
    met, real = [], spatial_join.points_in_areas
    monkeypatch.setattr(spatial_join, "points_in_areas", lambda p, a, *rest: met.append((p.count(), a.count())) or real(p, a, *rest))
    areas, points = copies(spark)
    # Point 300 stands in shape 2 and, as another row, in shape 1, whose first area it shares; 301 is alone in shape 2.
    more = spark.createDataFrame([(300, 205, 5), (300, 105, 5), (301, 206, 6), (301, 206, 6)], "p long, x long, y long")
    got = spatial_join.polygons_hit_once(points.select("p", "x", "y").unionByName(more), areas.selectExpr("parcel_id AS a", "xmin", "ymin", "xmax", "ymax"), "p", "a").collect()
    assert [tuple(r) for r in got] == [(301, 2)]
    assert met == [(7, 3)]


def test_many_rows_of_a_dimension_are_not_broadcast(spark, tmp_path, monkeypatch):
    from greenlake.plans import adapters

    for t in ("lineitem", "part", "supplier"):
        (tmp_path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    plan = lambda: adapters.load(spark, str(tmp_path), "tree")._jdf.queryExecution().executedPlan().toString()
    n = adapters.load(spark, str(tmp_path), "tree").count()
    assert plan().count("BroadcastHashJoin") == 2
    monkeypatch.setattr(adapters, "MOST_BROADCAST", 0)
    assert "BroadcastHashJoin" not in plan() and adapters.load(spark, str(tmp_path), "tree").count() == n
