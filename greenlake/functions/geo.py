"""Plane geometry as column arithmetic: points, boxes, and polygons held as arrays of rings of points.

A polygon is ``array<array<struct<x, y>>>``: the outer ring, then holes; rings are closed. Grid keys are
floors, so a point is in exactly one cell; boxes and polygons include their boundary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from greenlake.functions.text import col

RING = "array<struct<x: double, y: double>>"
POLYGON = f"array<{RING}>"

# The GRS80 ellipsoid and zone 55 of the map grid (central meridian 147 E).
_A, _F = 6378137.0, 1 / 298.257222101
_LON0, _K0, _FE, _FN = 147.0, 0.9996, 500000.0, 10000000.0


def to_map_grid(lon, lat) -> tuple[Column, Column]:
    """Easting and northing in metres from degrees, by Kruger's series to the fourth order."""
    n = _F / (2 - _F)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    e = math.sqrt(_F * (2 - _F))
    phi, lam = F.radians(col(lat)), F.radians(col(lon) - _LON0)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _FE + _K0 * radius * x, _FN + _K0 * radius * y


def from_map_grid(easting, northing) -> tuple[Column, Column]:
    """Longitude and latitude in degrees from metres, by the inverse series to the fourth order."""
    n = _F / (2 - _F)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    )
    delta = (
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    )
    y, x = (col(northing) - _FN) / (_K0 * radius), (col(easting) - _FE) / (_K0 * radius)
    xi, eta = y, x
    for j, b in enumerate(beta, 1):
        xi = xi - b * F.sin(2 * j * y) * F.cosh(2 * j * x)
        eta = eta - b * F.cos(2 * j * y) * F.sinh(2 * j * x)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return _LON0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


def on_map_grid(polygon: Column) -> Column:
    """A polygon of degrees (x: longitude, y: latitude) in metres."""

    def moved(v):
        x, y = to_map_grid(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(polygon, lambda r: F.transform(r, moved))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once and not at each place that ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tidied(polygon: Column) -> Column:
    """Rings closed, without points that repeat the one before or make a spike, and without holes that are then no rings."""

    def clean(ring):
        steps = F.filter(ring, lambda v, i: (i == 0) | (v != F.get(ring, i - 1)))
        closed = _bound(steps, lambda s: F.when((F.size(s) > 0) & (F.element_at(s, 1) != F.element_at(s, -1)), F.concat(s, F.slice(s, 1, 1))).otherwise(s))
        return _bound(closed, without_spikes)

    def without_spikes(closed):
        # A point between two equal ones is a spike; so is the second of those.
        spike = lambda i: (i > 0) & (i < F.size(closed) - 1) & (F.get(closed, i - 1) == F.get(closed, i + 1))
        return F.filter(closed, lambda v, i: ~(spike(i) | (spike(i - 1) & (i < F.size(closed) - 1))))

    rings = F.transform(polygon, clean)
    return F.filter(rings, lambda r, i: (i == 0) | (F.size(r) >= 4))


def distance(x0, y0, x1, y1) -> Column:
    dx, dy = col(x0) - col(x1), col(y0) - col(y1)
    return F.sqrt(dx * dx + dy * dy)


def distance_to_box(x, y, xmin, ymin, xmax, ymax) -> Column:
    """0 inside and on the edge."""
    dx = F.greatest(col(xmin) - col(x), F.lit(0.0), col(x) - col(xmax))
    dy = F.greatest(col(ymin) - col(y), F.lit(0.0), col(y) - col(ymax))
    return F.sqrt(dx * dx + dy * dy)


def in_box(x, y, xmin, ymin, xmax, ymax) -> Column:
    return col(x).between(col(xmin), col(xmax)) & col(y).between(col(ymin), col(ymax))


def _edges(ring: Column) -> Column:
    """Structs (a, b) of a ring's sides."""
    n = lambda r: F.greatest(F.size(r) - 1, F.lit(0))
    return _bound(ring, lambda r: F.zip_with(F.slice(r, 1, n(r)), F.slice(r, 2, n(r)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))


def ring_area(ring: Column) -> Column:
    twice = F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])
    return F.abs(twice) / 2


def polygon_area(polygon: Column) -> Column:
    """The outer ring's area less its holes'."""
    holes = lambda p: F.aggregate(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.lit(0.0), lambda s, r: s + ring_area(r))
    return _bound(polygon, lambda p: ring_area(p[0]) - holes(p))


def touches(e: Column, x: Column, y: Column) -> Column:
    """Whether a point is on a side."""
    a, b = e["a"], e["b"]
    cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
    return (cross == 0) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether a ray from a point to the right crosses a side, which holds its lower end and not its upper one."""
    a, b = e["a"], e["b"]
    return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"])


def in_polygon(polygon: Column, x, y) -> Column:
    """Even-odd ray cast over all rings, so holes are outside; the boundary is inside."""

    def holds(v):
        odd = F.aggregate(v["sides"], F.lit(0), lambda n, e: n + crosses(e, v["x"], v["y"]).cast("int")) % 2 == 1
        return F.exists(v["sides"], lambda e: touches(e, v["x"], v["y"])) | odd

    return _bound(F.struct(sides(polygon).alias("sides"), col(x).alias("x"), col(y).alias("y")), holds)


def sides(polygon: Column) -> Column:
    """All rings' sides as structs (a, b)."""
    return F.flatten(F.transform(polygon, _edges))


def _hand(a: Column, b: Column, c: Column) -> Column:
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def sides_meet(e: Column, f: Column) -> Column:
    """Whether two sides share a point."""
    apart = (_hand(e["a"], e["b"], f["a"]) * _hand(e["a"], e["b"], f["b"]) < 0) & (_hand(f["a"], f["b"], e["a"]) * _hand(f["a"], f["b"], e["b"]) < 0)
    ends = touches(e, f["a"]["x"], f["a"]["y"]) | touches(e, f["b"]["x"], f["b"]["y"]) | touches(f, e["a"]["x"], e["a"]["y"]) | touches(f, e["b"]["x"], e["b"]["y"])
    return apart | ends


def polygons_meet(p: Column, q: Column) -> Column:
    """A vertex of one in the other, or two sides that meet."""
    return (
        F.exists(F.flatten(p), lambda v: in_polygon(q, v["x"], v["y"])) | F.exists(F.flatten(q), lambda v: in_polygon(p, v["x"], v["y"]))
        | F.exists(sides(p), lambda e: F.exists(sides(q), lambda f: sides_meet(e, f)))
    )


def bounds(polygon: Column) -> dict[str, Column]:
    xs, ys = F.transform(polygon[0], lambda v: v["x"]), F.transform(polygon[0], lambda v: v["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def box_polygon(xmin, ymin, xmax, ymax) -> Column:
    p = lambda x, y: F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))
    return F.array(F.array(p(xmin, ymin), p(xmax, ymin), p(xmax, ymax), p(xmin, ymax), p(xmin, ymin)))


def circle(x, y, radius, sides: int = 24) -> Column:
    """A closed ring of ``sides`` equal sides as a polygon."""
    at = lambda i: i * F.lit(2 * math.pi / sides)
    ring = F.transform(
        F.sequence(F.lit(0), F.lit(sides)),
        lambda i: F.struct((col(x) + col(radius) * F.cos(at(i % sides))).alias("x"), (col(y) + col(radius) * F.sin(at(i % sides))).alias("y")),
    )
    return F.array(ring)


def clip_to_convex(ring: Column, clip: Column) -> Column:
    """A ring clipped by a convex counter-clockwise ring (Sutherland-Hodgman), closed; null when nothing is left."""

    def inside(e, p):
        return (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"]) >= 0

    def meet(e, p, q):
        ax, ay, bx, by = e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]
        num = (bx - ax) * (p["y"] - ay) - (by - ay) * (p["x"] - ax)
        den = num - ((bx - ax) * (q["y"] - ay) - (by - ay) * (q["x"] - ax))
        t = num / F.when(den != 0, den)
        return F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))

    def cut(points, e):
        n = F.size(points)
        pairs = F.zip_with(points, F.concat(F.slice(points, 2, F.greatest(n - 1, F.lit(0))), F.slice(points, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

        def piece(s):
            p, q = s["p"], s["q"]
            crossing = F.when(inside(e, p) != inside(e, q), F.array(meet(e, p, q))).otherwise(F.array().cast(RING))
            return F.concat(F.when(inside(e, p), F.array(p)).otherwise(F.array().cast(RING)), crossing)

        return F.when(n > 0, F.flatten(F.transform(pairs, piece))).otherwise(points)

    start = F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))).cast(RING)
    left = F.aggregate(_edges(clip), start, lambda acc, e: cut(acc, e).cast(RING))
    return _bound(left, lambda r: F.when(F.size(r) >= 3, F.concat(r, F.slice(r, 1, 1))))


def interior_point(polygon: Column) -> Column:
    """The outer ring's vertex mean where it is inside, else the middle of the widest inner stretch at its height."""
    mean = lambda ring, part: F.aggregate(F.transform(ring, lambda v: v[part]), F.lit(0.0), lambda a, b: a + b) / F.size(ring)
    middle = lambda ring: F.struct(mean(ring, "x").alias("x"), mean(ring, "y").alias("y"))

    def spans(at):
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.floor(F.size(at) / 2).cast("int") - 1, F.lit(0))),
            lambda i: F.struct((F.get(at, 2 * i + 1) - F.get(at, 2 * i)).alias("w"), ((F.get(at, 2 * i + 1) + F.get(at, 2 * i)) / 2).alias("x")),
        )

    def within(polygon, m):
        x, y = m["x"], m["y"]
        cut = F.filter(sides(polygon), lambda e: (e["a"]["y"] > y) != (e["b"]["y"] > y))
        at = F.array_sort(F.transform(cut, lambda e: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))
        return F.struct(F.when(in_polygon(polygon, x, y), x).otherwise(F.array_max(_bound(at, spans))["x"]).alias("x"), y.alias("y"))

    corners = lambda p: F.slice(p[0], 1, F.greatest(F.size(p[0]) - 1, F.lit(1)))
    return _bound(polygon, lambda p: _bound(_bound(corners(p), middle), lambda m: within(p, m)))


def valid_polygon(polygon: Column) -> Column:
    """Closed rings of four points or more and a positive area."""
    ok = lambda p: F.forall(p, lambda r: (F.size(r) >= 4) & (F.element_at(r, 1) == F.element_at(r, -1)))
    return F.coalesce(_bound(polygon, lambda p: (F.size(p) > 0) & ok(p) & (polygon_area(p) > 0)), F.lit(False))


def repaired_area(stored, measured) -> Column:
    """The measured area where the stored one is off by more than a metre and a hundredth of it, or missing."""
    bad = col(stored).isNull() | (F.abs(col(stored) - col(measured)) > F.greatest(F.lit(1.0), 0.01 * col(measured)))
    return F.when(bad, col(measured)).otherwise(col(stored))


def cell_key(x, y, size: float, prefix: str = "epsg7855") -> Column:
    """Key of the grid cell that holds a point, by its lower left corner."""
    at = lambda v: (F.floor(col(v) / size) * int(size)).cast("long").cast("string")
    return F.concat_ws(":", F.lit(prefix), at(x), at(y), F.lit(str(int(size))))


def web_tile(lon, lat, zoom: int) -> tuple[Column, Column]:
    """Column and row of the web-map tile that holds a point."""
    n = float(1 << zoom)
    x = F.floor((col(lon) + 180) / 360 * n)
    y = F.floor((1 - F.asinh(F.tan(F.radians(col(lat)))) / math.pi) / 2 * n)
    return x, y


def wkt_point(x, y) -> Column:
    return F.concat(F.lit("POINT ("), col(x).cast("string"), F.lit(" "), col(y).cast("string"), F.lit(")"))


def geojson_point(lon, lat, digits: int = 6) -> Column:
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(F.round(col(lon), digits), F.round(col(lat), digits)).alias("coordinates")))
