"""Spatial joins as equi-joins on grid buckets, confirmed by the exact predicate.

Areas are exploded into the buckets that their bounding box covers; a point is in one bucket, so a point
and an area meet at most once. Hot buckets are left to the adaptive skew join, which splits them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenlake.functions import geo
from greenlake.operators import polygon_tiles
from greenlake.sources.scratch import written

BUCKET = 1000.0


def _bucket(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def bucketed_points(df: DataFrame, size: float = BUCKET, x: str = "x", y: str = "y") -> DataFrame:
    return df.withColumns({"bx": _bucket(F.col(x), size), "by": _bucket(F.col(y), size)})


def bucketed_boxes(df: DataFrame, size: float = BUCKET, grow: Column | float = 0.0) -> DataFrame:
    """One row for each bucket that the box, grown on all sides, touches."""
    grow = F.lit(grow) if isinstance(grow, float) else grow
    span = lambda lo, hi: F.sequence(_bucket(F.col(lo) - grow, size), _bucket(F.col(hi) + grow, size))
    return df.withColumn("bx", F.explode(span("xmin", "xmax"))).withColumn("by", F.explode(span("ymin", "ymax")))


def subdivide(areas: DataFrame, size: float = BUCKET) -> DataFrame:
    """Areas by bucket, each row with the bucket's own box: the tiles of a boundary."""
    x = bucketed_boxes(areas, size)
    return x.withColumns({"tile_xmin": F.col("bx") * size, "tile_ymin": F.col("by") * size, "tile_xmax": (F.col("bx") + 1) * size, "tile_ymax": (F.col("by") + 1) * size})


def points_in_areas(points: DataFrame, areas: DataFrame, how: str = "inner", size: float = BUCKET, polygon: str | None = None) -> DataFrame:
    """Points with the areas that hold them, boundary included: boxes, or polygons with or without holes.

    ``how`` is inner, left, left_semi or left_anti. Area columns must not clash with the points'. Polygons are met
    through their tile index, and are not part of the result.
    """
    if polygon:
        return points_in_tiles(points, polygon_tiles.polygon_tiles(areas, polygon, size), how, size)
    p = bucketed_points(points, size)
    a = bucketed_boxes(areas, size).withColumnsRenamed({"bx": "a_bx", "by": "a_by"})
    exact = geo.in_box(F.col("x"), F.col("y"), "xmin", "ymin", "xmax", "ymax")
    # A point on the far edge of a box is in a bucket that the box also covers, as both ends take the floor.
    out = p.join(a, (F.col("bx") == F.col("a_bx")) & (F.col("by") == F.col("a_by")) & exact, how)
    return out.drop("bx", "by", "a_bx", "a_by")


def points_in_tiles(points: DataFrame, tiles: DataFrame, how: str = "inner", size: float = BUCKET) -> DataFrame:
    """Points with the areas of a polygon tile index (built for the same ``size``) that hold them; a point meets an area in one tile only."""
    t = polygon_tiles.bucketed_tiles(tiles, size).withColumnsRenamed({"bx": "a_bx", "by": "a_by"})
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    out = bucketed_points(points, size).join(t, (F.col("bx") == F.col("a_bx")) & (F.col("by") == F.col("a_by")) & polygon_tiles.in_tile(x, y), how)
    return out.drop("bx", "by", "a_bx", "a_by", *(c for c in tiles.columns if c.startswith("tile_")))


def polygons_meet_tiles(left: DataFrame, tiles: DataFrame, polygon: str, size: float = BUCKET) -> DataFrame:
    """Rows of ``left`` (polygon and the box around it) that meet an area of a tile index, boundaries included; equal rows are kept once.

    They meet where a vertex lies in a tile's part of the area, where two sides meet, or where the area lies within the polygon.
    """
    p = lambda s, a: F.struct(s[f"{a}x"].alias("x"), s[f"{a}y"].alias("y"))
    sides = F.transform("tile_sides", lambda s: F.struct(p(s, "a").alias("a"), p(s, "b").alias("b")))
    mine = F.col(polygon).cast(geo.POLYGON)
    meets = (
        F.exists(F.flatten(mine), lambda v: polygon_tiles.in_tile(v["x"], v["y"])) | F.exists(geo.sides(mine), lambda e: F.exists(sides, lambda f: geo.sides_meet(e, f)))
        | F.exists(sides, lambda f: geo.in_polygon(mine, f["a"]["x"], f["a"]["y"]))
    )
    t = polygon_tiles.bucketed_tiles(tiles, size).withColumnsRenamed({"bx": "a_bx", "by": "a_by"})
    x = bucketed_boxes(left, size).join(t, (F.col("bx") == F.col("a_bx")) & (F.col("by") == F.col("a_by")) & meets, "left_semi")
    return x.drop("bx", "by").dropDuplicates()


def areas_meet(left: DataFrame, right: DataFrame, how: str = "left_semi", size: float = BUCKET, polygons: tuple[str, str] | None = None) -> DataFrame:
    """Areas of ``left`` that meet one of ``right``; right's columns are renamed with ``r_`` first.

    With ``polygons``, the names of both sides' polygons, the right side's are met through their tile index, and ``how`` must be left_semi.
    """
    if polygons:
        if how != "left_semi":
            raise ValueError("polygons are met by left_semi only")
        return polygons_meet_tiles(left, polygon_tiles.polygon_tiles(right.select(polygons[1]), polygons[1], size), polygons[0], size)
    r = bucketed_boxes(right, size).toDF(*(f"r_{c}" for c in [*right.columns, "bx", "by"]))
    meet = (F.col("xmin") <= F.col("r_xmax")) & (F.col("xmax") >= F.col("r_xmin")) & (F.col("ymin") <= F.col("r_ymax")) & (F.col("ymax") >= F.col("r_ymin"))
    x = bucketed_boxes(left, size).join(r, (F.col("bx") == F.col("r_bx")) & (F.col("by") == F.col("r_by")) & meet, how)
    return x.drop("bx", "by", "r_bx", "r_by").dropDuplicates()


def self_crossings(areas: DataFrame, key: str, polygon: str) -> DataFrame:
    """Pairs of sides of one polygon that meet elsewhere than where neighbours do: key, and the two sides' numbers.

    Sides are met in buckets of the polygon's own scale, about one for each side, so a ring of n sides makes some n pairs and not
    n^2. A pair that shares several buckets counts in the first.
    """
    ring = F.transform(polygon, lambda r, i: F.transform(geo.sides(F.array(r)), lambda e, j: F.struct(i.alias("ring"), j.alias("seq"), F.greatest(F.size(r) - 1, F.lit(0)).alias("n"), e["a"].alias("a"), e["b"].alias("b"))))
    x = areas.select(F.col(key), polygon, *(c.alias(k) for k, c in geo.bounds(F.col(polygon)).items())).withColumn("_sides", F.flatten(ring))
    step = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(1e-9)) / F.greatest(F.sqrt(F.size("_sides").cast("double")), F.lit(1.0))
    x = x.withColumn("_step", step).select(key, "_step", F.explode("_sides").alias("s"))
    low, high = lambda v: F.floor(F.least(f"s.a.{v}", f"s.b.{v}") / F.col("_step")).cast("long"), lambda v: F.floor(F.greatest(f"s.a.{v}", f"s.b.{v}") / F.col("_step")).cast("long")
    x = x.withColumns({"lx": low("x"), "ly": low("y")}).withColumn("bx", F.explode(F.sequence("lx", high("x")))).withColumn("by", F.explode(F.sequence("ly", high("y"))))
    y = x.select(key, "bx", "by", F.col("s").alias("t"), F.col("lx").alias("mx"), F.col("ly").alias("my"))
    later = (F.col("s.ring") < F.col("t.ring")) | ((F.col("s.ring") == F.col("t.ring")) & (F.col("s.seq") < F.col("t.seq")))
    first = (F.col("bx") == F.greatest("lx", "mx")) & (F.col("by") == F.greatest("ly", "my"))
    same = F.col("s.ring") == F.col("t.ring")
    next_ = same & (F.col("t.seq") == F.col("s.seq") + 1)
    around = same & (F.col("s.seq") == 0) & (F.col("t.seq") == F.col("s.n") - 1)
    # Neighbours share an end; they cross where the far end of one lies on the other.
    folded = F.when(next_, geo.touches(F.col("s"), F.col("t.b.x"), F.col("t.b.y")) | geo.touches(F.col("t"), F.col("s.a.x"), F.col("s.a.y")))
    folded = folded.when(around, geo.touches(F.col("s"), F.col("t.a.x"), F.col("t.a.y")) | geo.touches(F.col("t"), F.col("s.b.x"), F.col("s.b.y")))
    crossing = folded.otherwise(geo.sides_meet(F.col("s"), F.col("t")))
    side = lambda s: F.concat_ws(":", f"{s}.ring", f"{s}.seq")
    return x.join(y, [key, "bx", "by"]).where(later & first).where(crossing).select(key, side("s").alias("side"), side("t").alias("other"))


def _shapes(areas: DataFrame, polygon: str | None) -> DataFrame:
    """Areas with a value (_shape) that those of one box or polygon share."""
    return areas.withColumn("_shape", F.sha2(F.to_json(polygon), 256) if polygon else F.struct("xmin", "ymin", "xmax", "ymax"))


def sums_in_areas(areas: DataFrame, points: DataFrame, key: str, sums: dict[str, Column], size: float = BUCKET, polygon: str | None = None) -> DataFrame:
    """The areas that hold a point, with sums over their points: ``sums`` maps a name to what a point counts for.

    Points of one place are added up before they are met, and areas of one shape are met once, so the pairs grow with places and shapes, not
    with the product of their copies.
    """
    shape = [polygon] if polygon else ["xmin", "ymin", "xmax", "ymax"]
    total = [F.sum(n).alias(n) for n in sums]
    a = _shapes(areas.select(key, *shape), polygon)
    places = points.select("x", "y", *(c.alias(n) for n, c in sums.items())).groupBy("x", "y").agg(*total)
    shapes = a.groupBy("_shape").agg(*(F.any_value(c).alias(c) for c in shape))
    n = points_in_areas(places, shapes, "inner", size, polygon).groupBy("_shape").agg(*total)
    return a.select(key, "_shape").join(n, "_shape").groupBy(key).agg(*total)


def count_in_areas(areas: DataFrame, points: DataFrame, key: str, name: str = "n_points", size: float = BUCKET, polygon: str | None = None) -> DataFrame:
    """Every area with the number of points in it, 0 where none are."""
    n = sums_in_areas(areas, points, key, {name: F.lit(1)}, size, polygon)
    return areas.join(n, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def within_radius(centres: DataFrame, points: DataFrame, radius: Column | float, size: float = BUCKET) -> DataFrame:
    """Pairs of centres (cx, cy) and points no further apart than the radius, with their distance."""
    r = F.lit(radius) if isinstance(radius, float) else radius
    c = centres.withColumns({"xmin": F.col("cx") - r, "xmax": F.col("cx") + r, "ymin": F.col("cy") - r, "ymax": F.col("cy") + r, "_r": r})
    c = bucketed_boxes(c, size).drop("xmin", "ymin", "xmax", "ymax").withColumnsRenamed({"bx": "c_bx", "by": "c_by"})
    d = geo.distance("cx", "cy", "x", "y")
    x = c.join(bucketed_points(points, size), (F.col("bx") == F.col("c_bx")) & (F.col("by") == F.col("c_by")) & (d <= F.col("_r")))
    return x.withColumn("distance_m", d).drop("bx", "by", "c_bx", "c_by", "_r")


def boxes_within_radius(centres: DataFrame, boxes: DataFrame, radius: float, size: float = BUCKET) -> DataFrame:
    """Pairs of centres and boxes no further apart than the radius; a pair is found in several buckets and kept once."""
    c = centres.withColumns({"c_x0": F.col("cx") - radius, "c_x1": F.col("cx") + radius, "c_y0": F.col("cy") - radius, "c_y1": F.col("cy") + radius})
    span = lambda lo, hi: F.sequence(_bucket(F.col(lo), size), _bucket(F.col(hi), size))
    c = c.withColumn("c_bx", F.explode(span("c_x0", "c_x1"))).withColumn("c_by", F.explode(span("c_y0", "c_y1")))
    d = geo.distance_to_box("cx", "cy", "xmin", "ymin", "xmax", "ymax")
    b = bucketed_boxes(boxes, size)
    # Only the first shared bucket counts, so no distinct is needed.
    first = (F.col("bx") == F.greatest(_bucket(F.col("c_x0"), size), _bucket(F.col("xmin"), size))) & (F.col("by") == F.greatest(_bucket(F.col("c_y0"), size), _bucket(F.col("ymin"), size)))
    x = c.join(b, (F.col("bx") == F.col("c_bx")) & (F.col("by") == F.col("c_by")) & (d <= radius) & first)
    return x.withColumn("distance_m", d).drop("bx", "by", "c_bx", "c_by", "c_x0", "c_x1", "c_y0", "c_y1")


#: Halvings of the radius down to which buckets are counted for :func:`near_pairs`; of boxes fewer, as they stand in each bucket they touch.
POINT_LEVELS, BOX_LEVELS = 10, 3


def near_pairs(centres: DataFrame, things: DataFrame, radius: float, k: int) -> DataFrame:
    """Pairs of centres (centre_id, cx, cy) and things (id, and x, y or a box) with their distance: at least each centre's ``k`` nearest within the radius.

    Things are counted in buckets of the radius, its half, its quarter and so on. A bucket with ``k`` things around a centre
    proves that the k nearest are no further than its diagonal; the finest such bucket sets how far, and by buckets of which size,
    a centre is searched. Where things are dense, pairs within the whole radius are therefore never made, and the k nearest, with all
    that are as far as the last of them, always are.
    """
    boxes = "xmin" in things.columns
    levels = BOX_LEVELS if boxes else POINT_LEVELS
    span = ("xmin", "ymin", "xmax", "ymax") if boxes else ("x", "y", "x", "y")
    t = things.select("id", *(F.col(c).cast("double").alias(n) for c, n in zip(span, ("x0", "y0", "x1", "y1")))).where("x0 is not null and y0 is not null and x1 is not null and y1 is not null")
    c = centres.select("centre_id", F.col("cx").cast("double").alias("cx"), F.col("cy").cast("double").alias("cy")).where("cx is not null and cy is not null")
    finest = radius / 2**levels
    size = lambda level: F.lit(radius) / F.pow(F.lit(2.0), level)
    at = lambda v, level: F.floor(v / size(level)).cast("long")
    # Counts of the middle points: bottom up, so that all but the finest are sums of a few.
    n = t.select(_bucket((F.col("x0") + F.col("x1")) / 2, finest).alias("fx"), _bucket((F.col("y0") + F.col("y1")) / 2, finest).alias("fy")).groupBy("fx", "fy").agg(F.count("*").alias("n"))
    n = n.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    up = lambda v: F.floor(F.col(v) / F.pow(F.lit(2.0), levels - F.col("level"))).cast("long")
    full = n.groupBy("level", up("fx").alias("bx"), up("fy").alias("by")).agg(F.sum("n").alias("n")).where(F.col("n") >= k).select("level", "bx", "by")
    own = c.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    own = own.withColumns({"bx": _up_from(finest, F.col("cx"), levels), "by": _up_from(finest, F.col("cy"), levels)})
    # Both sides grow with the input, so neither is to be broadcast.
    own = own.join(full.withColumn("_full", F.lit(True)).hint("merge"), ["level", "bx", "by"], "left")
    c = own.groupBy("centre_id", "cx", "cy").agg(F.max(F.when(F.col("_full"), F.col("level"))).alias("best"))
    reach = F.least(F.lit(float(radius)), F.coalesce(size(F.col("best")) * math.sqrt(2) * (1 + 1e-9), F.lit(float(radius))))
    # Twice the proven bucket's size is more than its diagonal, so the search touches three buckets a side at most.
    c = c.withColumns({"reach": reach, "level": F.greatest(F.coalesce(F.col("best"), F.lit(0)) - 1, F.lit(0))})
    c = written(c.drop("best"), "reach")
    used = [r[0] for r in c.select("level").distinct().collect()]  # one for each level at most
    low = {"lx": at(F.col("cx") - F.col("reach"), F.col("level")), "ly": at(F.col("cy") - F.col("reach"), F.col("level"))}
    c = c.withColumns(low).withColumn("bx", F.explode(F.sequence("lx", at(F.col("cx") + F.col("reach"), F.col("level")))))
    c = c.withColumn("by", F.explode(F.sequence("ly", at(F.col("cy") + F.col("reach"), F.col("level")))))
    t = t.withColumn("level", F.explode(F.array(*map(F.lit, sorted(used))) if used else F.array().cast("array<int>")))
    t = t.withColumns({"tx": at(F.col("x0"), F.col("level")), "ty": at(F.col("y0"), F.col("level"))})
    t = t.withColumn("bx", F.explode(F.sequence("tx", at(F.col("x1"), F.col("level"))))).withColumn("by", F.explode(F.sequence("ty", at(F.col("y1"), F.col("level")))))
    d = geo.distance_to_box("cx", "cy", "x0", "y0", "x1", "y1")
    # A pair that shares several buckets counts in the first.
    first = (F.col("bx") == F.greatest("lx", "tx")) & (F.col("by") == F.greatest("ly", "ty"))
    return c.join(t, ["level", "bx", "by"]).where(first & (d <= F.col("reach"))).select("centre_id", "id", d.alias("distance_m"))


def _up_from(finest: float, v: Column, levels: int) -> Column:
    """A value's bucket at ``level``, by way of its finest bucket, so that counts and places agree to the last bit."""
    return F.floor(_bucket(v, finest) / F.pow(F.lit(2.0), levels - F.col("level"))).cast("long")


def top_k(pairs: DataFrame, by: list[str], k: int, *order) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def smallest_area(points: DataFrame, areas: DataFrame, key: str, take: str, size: float = BUCKET, largest: bool = False) -> DataFrame:
    """For each point the area of the least (or greatest) ``area_m2`` that holds it, ties by ``take``; null where none does."""
    x = points_in_areas(points, areas, "left", size)
    order = F.struct(-F.col("area_m2") if largest else F.col("area_m2"), F.col(take))
    return x.groupBy(key).agg(F.min_by(take, order).alias(take))


#: So many sites are searched as a list of literals, without a join.
FEW_SITES = 64


def nearest(queries: DataFrame, sites: DataFrame, key: str, site_key: str, start: float = 1000.0, few: int = FEW_SITES) -> DataFrame:
    """The nearest site of each query, ties by site: columns key, site_key and distance_m.

    Up to ``few`` sites become literals. More are met through buckets whose size doubles, each round for the
    queries that no site within the last size was found for, until one size spans all sites and queries; what is left
    after each round is written, so the plan does not grow. Queries without a place have no row.
    """
    s = sites.select(site_key, "x", "y").where("x is not null and y is not null")
    q = queries.select(key, F.col("x").alias("qx"), F.col("y").alias("qy")).where("qx is not null and qy is not null")
    at_hand = s.limit(few + 1).collect()
    if not at_hand:
        return q.where("false").select(key, F.lit(None).cast(s.schema[site_key].dataType).alias(site_key), F.lit(0.0).alias("distance_m"))
    if len(at_hand) <= few:
        kind = s.schema[site_key].dataType
        each = (F.struct(geo.distance("qx", "qy", F.lit(r["x"]), F.lit(r["y"])).alias("distance_m"), F.lit(r[site_key]).cast(kind).alias(site_key)) for r in at_hand)
        x = q.withColumn("b", F.array_min(F.array(*each)))
        return x.select(key, f"b.{site_key}", "b.distance_m")
    d = geo.distance("qx", "qy", "x", "y")
    best = F.min(F.struct(d.alias("distance_m"), F.col(site_key))).alias("b")
    ends = q.selectExpr("qx AS x", "qy AS y").unionByName(s.select("x", "y")).agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    span = math.hypot(float((ends[1] or 0) - (ends[0] or 0)), float((ends[3] or 0) - (ends[2] or 0))) + 1.0
    parts, size = [], min(start, span)
    while True:
        c = q.withColumns({"xmin": F.col("qx") - size, "xmax": F.col("qx") + size, "ymin": F.col("qy") - size, "ymax": F.col("qy") + size})
        c = bucketed_boxes(c, size).drop("xmin", "xmax", "ymin", "ymax")
        x = c.join(bucketed_points(s, size), ["bx", "by"]).where(d <= size).groupBy(key).agg(best).select(key, f"b.{site_key}", "b.distance_m")
        parts.append(written(x, "nearest"))
        if size >= span:
            break
        q = written(q.join(parts[-1].select(key), key, "left_anti"), "nearest-rest")
        if q.isEmpty():
            break
        size = min(size * 2, span)
    return reduce(DataFrame.unionByName, parts)


#: So many places go to every task, which takes some 100 bytes for each.
FEW_PLACES = 200_000


def polygons_hit_once(points: DataFrame, areas: DataFrame, point_key: str, area_key: str, size: float = BUCKET, polygon: str | None = None) -> DataFrame:
    """Each point's first area by key, kept only where that area has no other point; places are met with the first area of each shape."""
    shape = [polygon] if polygon else ["xmin", "ymin", "xmax", "ymax"]
    first = F.min(area_key).alias(area_key)
    shapes = _shapes(areas.select(area_key, *shape), polygon).groupBy("_shape").agg(first, *(F.any_value(c).alias(c) for c in shape)).drop("_shape")
    places = points_in_areas(points.select("x", "y").distinct(), shapes, "inner", size, polygon).groupBy("x", "y").agg(first)
    places = written(places, "places")
    if places.count() <= FEW_PLACES:
        places = F.broadcast(places)
    x = points.select(point_key, "x", "y").join(places, ["x", "y"]).groupBy(point_key).agg(first)
    alone = x.groupBy(area_key).agg(F.count("*").alias("n"), F.min(point_key).alias(point_key)).where("n = 1")
    return alone.select(point_key, area_key)
