"""Queries over polygons with many corners and holes: the tile index against ray casting in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.operators import canopy_ledger, contracts, polygon_tiles, property, spatial_join
from greenlake.plans import pipelines
from greenlake.plans.adapters import TABLES
from greenlake.plans.queries import query
from greenlake.sources.scratch import scratch_path

_DIGITS = "(VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9))"

# A district for each nation: a ring with saw teeth along its lower and upper side, and a hole that is not convex.
TABLES["district_corner"] = (("nation",), f"""
    SELECT n_nationkey AS district_id, ring, seq, (n_nationkey % 5) * 12000 + dx AS x, CAST(floor(n_nationkey / 5) AS BIGINT) * 12000 + dy AS y FROM nation CROSS JOIN (
        SELECT 0 AS ring, a.d * 10 + b.d AS seq, (a.d * 10 + b.d) * 110 + 500 AS dx, (a.d * 10 + b.d) * 37 % 7 * 550 AS dy FROM {_DIGITS} AS a(d) CROSS JOIN {_DIGITS} AS b(d)
        UNION ALL SELECT 0, 100 + a.d * 10 + b.d, 11390 - (a.d * 10 + b.d) * 110, 12000 - (a.d * 10 + b.d) * 53 % 11 * 350 FROM {_DIGITS} AS a(d) CROSS JOIN {_DIGITS} AS b(d)
        UNION ALL SELECT 0, 200, 500, 0
        UNION ALL SELECT 1, seq, dx, dy FROM (VALUES (0, 4000, 5000), (1, 8000, 5000), (2, 6500, 6100), (3, 8000, 8000), (4, 4000, 8000), (5, 5000, 6500), (6, 4000, 5000)) AS h(seq, dx, dy)
    ) AS v""")  # fmt: skip

# An arrow head for each parcel: a ring of five corners, one of them pointing inwards.
TABLES["parcel_corner"] = (("customer",), """
    SELECT c_custkey AS parcel_id, seq, (c_custkey * 7919) % 60000 + dx * (8 + c_custkey % 20) * 4 AS x, (c_custkey * 104729) % 60000 + dy * (8 + c_custkey % 20) * 4 AS y
    FROM customer CROSS JOIN (VALUES (0, -2, -1), (1, 0, 0), (2, 2, -1), (3, 0, 3), (4, -2, -1)) AS v(seq, dx, dy)""")

_SIDES = "SELECT a.{0}, a.x ax, a.y ay, b.x bx, b.y cy FROM {1} a JOIN {1} b ON a.{0} = b.{0} {2} AND b.seq = a.seq + 1"
_DISTRICT_SIDES = _SIDES.format("district_id", "district_corner", "AND a.ring = b.ring")
_PARCEL_SIDES = _SIDES.format("parcel_id", "parcel_corner", "")


def _ray(points: str, key: str, sides: str, area: str) -> str:
    """Pairs of points and areas by the even-odd rule, with the boundary."""
    turn = "(CAST(bx - ax AS DOUBLE) * (y - ay) - CAST(cy - ay AS DOUBLE) * (x - ax))"
    return f"""
    SELECT {key}, {area} FROM {points} p JOIN (SELECT *, min(least(ax, bx)) OVER w x0, max(greatest(ax, bx)) OVER w x1, min(least(ay, cy)) OVER w y0, max(greatest(ay, cy)) OVER w y1 FROM {sides} WINDOW w AS (PARTITION BY {area})) s
        ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1
    GROUP BY {key}, {area}
    HAVING bool_or({turn} = 0 AND x BETWEEN least(ax, bx) AND greatest(ax, bx) AND y BETWEEN least(ay, cy) AND greatest(ay, cy))
        OR count(*) FILTER ((ay > y) <> (cy > y) AND x < CAST(bx - ax AS DOUBLE) * (y - ay) / CAST(cy - ay AS DOUBLE) + ax) % 2 = 1"""


def polygons(corners: DataFrame, key: str) -> DataFrame:
    """Polygons of rows (key, ring, seq, x, y); a ring's corners come together, as a polygon is one value."""
    at = F.struct("seq", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rings = corners.groupBy(key, "ring").agg(F.transform(F.sort_array(F.collect_list(at)), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"))).alias("corners"))
    return rings.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("ring", "corners"))), lambda r: r["corners"]).alias("polygon"))


def _districts(t):
    return polygons(t("district_corner"), "district_id")


def _parcels(t):
    x = polygons(t("parcel_corner").withColumn("ring", F.lit(0)), "parcel_id")
    return x.withColumns(geo.bounds(F.col("polygon")))


@query("district_id:l, n_trees:l", f"""
    WITH side AS ({_DISTRICT_SIDES}), t AS (SELECT x, y, count(*) c FROM urban_tree GROUP BY x, y), h AS ({_ray('t', 'x, y, c', 'side', 'district_id')})
    SELECT district_id, coalesce(n, 0) n_trees FROM (SELECT DISTINCT district_id FROM side) LEFT JOIN (SELECT district_id, sum(c) n FROM h GROUP BY 1) USING (district_id)""", "district_corner urban_tree")
def trees_per_district(t):
    return spatial_join.count_in_areas(_districts(t), t("urban_tree"), "district_id", "n_trees", polygon="polygon")


@query("parcel_id:l", f"""
    WITH side AS ({_DISTRICT_SIDES} WHERE a.district_id % 2 = 0), p AS (SELECT parcel_id, x, y FROM parcel) SELECT DISTINCT parcel_id FROM ({_ray('p', 'parcel_id, x, y', 'side', 'district_id')})""", "district_corner parcel")
def clip_to_districts(t):
    """Parcels by their middle point, as grid cells are kept by their centre."""
    return spatial_join.points_in_areas(t("parcel"), _districts(t).where("district_id % 2 = 0"), "left_semi", polygon="polygon")


@query("parcel_id:l", f"""
    WITH d AS ({_DISTRICT_SIDES} WHERE a.district_id % 2 = 0), s AS ({_PARCEL_SIDES}), e AS (SELECT *, least(ax, bx) x0, greatest(ax, bx) x1, least(ay, cy) y0, greatest(ay, cy) y1 FROM d),
    pc AS (SELECT parcel_id, seq, x, y FROM parcel_corner), dc AS (SELECT DISTINCT x, y FROM district_corner WHERE district_id % 2 = 0),
    inside AS (SELECT DISTINCT parcel_id FROM ({_ray('pc', 'parcel_id, seq, x, y', 'd', 'district_id')})),
    around AS (SELECT DISTINCT parcel_id FROM ({_ray('dc', 'x, y', 's', 'parcel_id')})),
    h AS (SELECT parcel_id, CAST(e.bx - e.ax AS DOUBLE) * (s.ay - e.ay) - CAST(e.cy - e.ay AS DOUBLE) * (s.ax - e.ax) h1, CAST(e.bx - e.ax AS DOUBLE) * (s.cy - e.ay) - CAST(e.cy - e.ay AS DOUBLE) * (s.bx - e.ax) h2,
                 CAST(s.bx - s.ax AS DOUBLE) * (e.ay - s.ay) - CAST(s.cy - s.ay AS DOUBLE) * (e.ax - s.ax) h3, CAST(s.bx - s.ax AS DOUBLE) * (e.cy - s.ay) - CAST(s.cy - s.ay AS DOUBLE) * (e.bx - s.ax) h4
          FROM s JOIN e ON least(s.ax, s.bx) <= x1 AND greatest(s.ax, s.bx) >= x0 AND least(s.ay, s.cy) <= y1 AND greatest(s.ay, s.cy) >= y0)
    SELECT parcel_id FROM inside UNION SELECT parcel_id FROM around UNION SELECT parcel_id FROM h WHERE h1 * h2 <= 0 AND h3 * h4 <= 0""", "district_corner parcel_corner")
def parcels_meeting_districts(t):
    return spatial_join.areas_meet(_parcels(t), _districts(t).where("district_id % 2 = 0"), polygons=("polygon", "polygon")).select("parcel_id")


@query("p:l, a:l", f"""
    WITH side AS ({_PARCEL_SIDES}), t AS (SELECT l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey id, any_value(x) x, any_value(y) y FROM tree GROUP BY 1),
    h AS (SELECT id, min(parcel_id) a FROM ({_ray('t', 'id, x, y', 'side', 'parcel_id')}) GROUP BY id)
    SELECT min(id) p, a FROM h GROUP BY a HAVING count(*) = 1""", "tree parcel_corner")
def lone_trees_in_rings(t):
    """Trees that stand alone in a parcel whose ring isn't convex."""
    trees = t("tree").selectExpr("l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey AS p", "x", "y")
    return spatial_join.polygons_hit_once(trees, _parcels(t).selectExpr("parcel_id AS a", "polygon"), "p", "a", polygon="polygon")


@query("district_id:l, area_m2:d", f"""
    WITH side AS ({_DISTRICT_SIDES.replace('a.district_id,', 'a.district_id, a.ring,')})
    SELECT district_id, sum(CASE WHEN ring = 0 THEN a ELSE -a END) area_m2 FROM (SELECT district_id, ring, abs(sum(CAST(ax AS DOUBLE) * cy - CAST(bx AS DOUBLE) * ay)) / 2 a FROM side GROUP BY ALL) GROUP BY district_id""", "district_corner")
def district_tiles(t):
    """Stored boundary tiles add up to their district's area."""
    d = _districts(t)
    tiles = polygon_tiles.clipped(polygon_tiles.polygon_tiles(d, "polygon", 2000.0), d, "polygon", "district_id")
    return tiles.groupBy("district_id").agg(F.round(F.sum("tile_area_m2"), 3).alias("area_m2"))


@query("centre_id:l, scientific_name:s, common_name:s, distance_m:d, rank:l", """
    WITH t AS (SELECT x * 100000 + y AS id, x, y, any_value(scientific_name ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) scientific_name, any_value(common_name ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) common_name FROM tree GROUP BY x, y)
    SELECT parcel_id centre_id, scientific_name, common_name, round(sqrt((t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y)), 2) distance_m,
           row_number() OVER (PARTITION BY parcel_id ORDER BY sqrt((t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y)), CAST(id AS VARCHAR)) rank
    FROM parcel p JOIN t ON t.x BETWEEN p.x - 800 AND p.x + 800 AND t.y BETWEEN p.y - 800 AND p.y + 800 AND (t.x - p.x) * (t.x - p.x) + (t.y - p.y) * (t.y - p.y) <= 640000
    QUALIFY rank <= 3""", "parcel tree")
def named_trees_near(t):
    """One tree for each place, the first of those that stand there."""
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    trees = t("tree").groupBy("x", "y").agg(F.min_by(F.struct("scientific_name", "common_name"), order).alias("n")).selectExpr("x * 100000 + y AS id", "x", "y", "n.*")
    return property.named_trees_near(t("parcel").selectExpr("parcel_id AS centre_id", "x AS cx", "y AS cy"), trees, 800.0, 3)


@query("c_custkey:l, lon:d, lat:d, back_mm:l", """
    SELECT c_custkey, 144.5 + c_custkey % 1000 / 1000.0::DOUBLE lon, -38.2 + c_custkey % 997 / 1000.0::DOUBLE lat, 0 back_mm FROM customer""")
def grid_round_trip(t):
    """Degrees to metres and back give the degrees again, and metres to degrees and back the metres to a millimetre."""
    x, y = geo.to_map_grid(F.expr("144.5D + c_custkey % 1000 / 1000D"), F.expr("-38.2D + c_custkey % 997 / 1000D"))
    p = t("customer").select("c_custkey", x.alias("x"), y.alias("y"))
    lon, lat = geo.from_map_grid("x", "y")
    p = p.withColumns({"lon": F.round(lon, 9), "lat": F.round(lat, 9)})
    x2, y2 = geo.to_map_grid("lon", "lat")
    return p.select("c_custkey", "lon", "lat", F.round(geo.distance("x", "y", x2, y2) * 1000).alias("back_mm"))


_KINDS = ("round", "open", "bow", "twice", "spike", "none")


@query("kind:s, n_kept:l, area_m2:d, n_repaired:l", """
    WITH p AS (SELECT CASE parcel_id % 6 WHEN 0 THEN 'round' WHEN 1 THEN 'open' WHEN 2 THEN 'bow' WHEN 3 THEN 'twice' WHEN 4 THEN 'spike' ELSE 'none' END kind, area_m2 FROM parcel)
    SELECT kind, count(*) n_kept, sum(area_m2) area_m2, CASE WHEN kind = 'round' THEN 0 ELSE count(*) END n_repaired FROM p WHERE kind NOT IN ('bow', 'none') GROUP BY kind""", "parcel")
def vector_preparation(t):
    """Boxes as they are, not closed, crossing themselves, with a point twice, with a spike, and none at all."""
    at = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    a, b, c, d = at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax")
    far = F.struct((F.col("xmax") + 5).cast("double").alias("x"), F.col("ymax").cast("double").alias("y"))
    rings = ((a, b, c, d, a), (a, b, c, d), (a, c, b, d, a), (a, b, b, c, d, a), (a, b, c, far, c, d, a))
    ring = F.lit(None).cast(geo.POLYGON)
    for i, r in enumerate(rings):
        ring = F.when(F.col("parcel_id") % 6 == i, F.array(F.array(*r))).otherwise(ring)
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("parcel_id") % 6 + 1).cast("int"))
    good, _ = pipelines.prepare_vector(t("parcel").select("parcel_id", kind.alias("kind"), ring.alias("polygon")), key="parcel_id")
    return good.groupBy("kind").agg(F.count("*").alias("n_kept"), F.sum("area_m2").alias("area_m2"), F.count_if("repaired").alias("n_repaired"))


@query("cell_x:l, cell_y:l, canopy_pct:d, n_tiles:l", """
    SELECT floor(x / 5000) cell_x, floor(y / 5000) cell_y, round(count_if(value = 1) / count(*) * 100, 2) canopy_pct, count(DISTINCT tile_id) n_tiles FROM pixel WHERE value <> 255 GROUP BY 1, 2""", "pixel")
def canopy_in_runs(t):
    """Cells from tiles that come in over three runs, the second of them repeated."""
    pixels = t("pixel").select("tile_id", "x", "y", "value")
    tiles = pixels.select("tile_id").distinct().withColumn("sha256", F.sha2(F.col("tile_id").cast("string"), 256))
    table = scratch_path(tiles.sparkSession, "ledger")
    for part in (0, 1, 1, 2):
        build = canopy_ledger.add_tiles(table, tiles, pixels, 5000.0, only=tiles.where(F.col("tile_id") % 3 == part))
    return canopy_ledger.merged(tiles.sparkSession, table, build, tiles, 5000.0)


@query("p_partkey:l, failures:s, passed:b", """
    SELECT p_partkey, CASE p_partkey % 5 WHEN 1 THEN 'range.metric:missing' WHEN 2 THEN 'range.minimum:number,status:value' WHEN 3 THEN 'status:object' ELSE '' END failures, p_partkey % 5 IN (0, 4) passed FROM part""")
def golden_cases(t):
    """Nested answers with more than is expected, something missing, other values, a value for an object, and numbers within the tolerance."""
    j = lambda s: F.expr(s)
    actual = j("""concat('{"status": "s', p_size, '", "range": {"minimum": ', p_size, ', "maximum": {"value": ', p_retailprice, '}}, "list": [1, {"a": null}], "more": {}}')""")
    expected = j("""CASE p_partkey % 5 WHEN 0 THEN concat('{"range": {"maximum": {"value": ', p_retailprice, '}, "minimum": ', p_size + 0.0005D, '}, "list": [1, {"a": null}]}')
        WHEN 1 THEN '{"range": {"metric": {"unit": "c"}}}' WHEN 2 THEN concat('{"status": "other", "range": {"minimum": ', p_size + 1, '}}') WHEN 3 THEN '{"status": {"a": {"b": 1}}}' ELSE '{}' END""")
    return contracts.compare_nested(t("part").select("p_partkey", actual.alias("answer")), t("part").select("p_partkey", expected.alias("answer")), "p_partkey", "answer")


@query("model_code:s, version_label:s, n_sources:l, first_source:s, all_allowed:b", """
    WITH s AS (SELECT p_brand model_code, p_type source_name, bool_and(p_size > 3) allowed FROM part GROUP BY ALL)
    SELECT b.model_code, 'v1' version_label, count(s.source_name) n_sources, min(s.source_name) first_source, coalesce(bool_and(allowed), true) all_allowed
    FROM (SELECT DISTINCT p_brand model_code FROM part UNION ALL SELECT 'none') b LEFT JOIN s USING (model_code) GROUP BY b.model_code""")  # fmt: skip
def model_contracts(t):
    p = t("part")
    spec = p.selectExpr("p_brand AS model_code").distinct().unionByName(p.sparkSession.createDataFrame([("none",)], "model_code string")).withColumn("model_version_id", F.lit(1))
    models = p.sparkSession.createDataFrame([(1, "m", "v1")], "model_version_id int, model_name string, version_label string")
    sources = p.select(F.col("p_type").alias("source_id")).distinct().selectExpr("source_id", "source_id AS source_name", "CAST(NULL AS STRING) AS licence", "'open_confirmed' AS licence_status")
    links = p.groupBy(F.col("p_brand").alias("model_code"), F.col("p_type").alias("source_id")).agg(F.lit("target").alias("source_role"), F.lit(True).alias("required_for_training"), F.min(F.col("p_size") > 3).alias("training_use_allowed"))
    x = contracts.model_contracts(spec, models, links, sources)
    entries = F.from_json("source_contract", "array<struct<source_name: string, training_use_allowed: boolean>>")
    return x.select("model_code", "version_label", F.size(entries).alias("n_sources"), F.get(entries, F.lit(0))["source_name"].alias("first_source"), F.forall(entries, lambda e: e["training_use_allowed"]).alias("all_allowed"))
