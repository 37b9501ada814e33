import math

import pytest
from pyspark.sql import functions as F

from greenlake.functions import classify, geo, ranges, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_text(spark):
    lit = F.lit
    assert one(spark, text.clean(lit(" Unknown ")), text.clean(lit("TBD")), text.clean(lit(" a  b "))) == (None, None, "a b")
    assert one(spark, text.positive_float(lit("1,234.5")), text.positive_float(lit("-3")), text.positive_float(lit("x")), text.positive_float(lit("85"), 0.1)) == (1234.5, None, None, 8.5)
    r = one(spark, text.numeric_range(lit("5-10 m")), text.numeric_range(lit("none")), text.numeric_range(lit("50 to 100"), 0.1))
    assert [tuple(x) for x in r] == [(5, 10), (None, None), (5, 10)]
    assert [str(x) for x in one(spark, text.iso_date(lit("2024-02-30")), text.iso_date(lit("2024-02-29T10:00")))] == ["None", "2024-02-29"]
    names = [("Acacia", "A. baileyana"), ("Eucalyptus", "species"), (None, "Ulmus parvifolia"), ("Acacia", "acacia dealbata"), (None, None), ("Acacia", None)]
    got = [tuple(one(spark, text.scientific_name(lit(g).cast("string"), lit(s).cast("string")))[0]) for g, s in names]
    assert got == [("Acacia baileyana", "species"), ("Eucalyptus sp.", "genus"), ("Ulmus parvifolia", "species"), ("acacia dealbata", "species"), (None, None), ("Acacia sp.", "genus")]
    a, b = one(spark, text.stable_id("k", lit(None), lit("x")), text.stable_id("k", lit("x"), lit(None)))
    assert a != b and a.startswith("k:") and len(a) == 34


def test_addresses(spark):
    lit = F.lit
    assert one(spark, text.normalize_address(lit(" 10  test rd St Kilda ave ")), text.council_name(lit("City of Port Phillip")), text.council_name(lit("Casey City Council"))) == (
        "10 TEST ROAD ST KILDA AVENUE", "PORT PHILLIP", "CASEY",
    )
    got = one(spark, text.prefix_candidates(lit("15 seascape st clayton")), text.prefix_candidates(lit("1 st kilda rd")), text.prefix_candidates(lit("ST ST ST ST ST ST")))
    assert got[0] == ["15 SEASCAPE ST CLAYTON", "15 SEASCAPE STREET CLAYTON"]
    assert got[1][0] == "1 ST KILDA RD" and {"1 ST KILDA ROAD", "1 STREET KILDA ROAD"} <= set(got[1]) and len(got[2]) == 8


def test_bands(spark):
    t = lambda x: one(spark, classify.temperature_band(F.lit(x).cast("double")))[0]
    assert [t(x) for x in (27, 27.01, 30, 30.01, None, math.nan, math.inf)] == ["Low", "Medium", "Medium", "High", "Unavailable", "Unavailable", "Unavailable"]
    c = lambda x, **k: one(spark, classify.canopy_band(F.lit(x).cast("double"), **k))[0]
    assert [c(x) for x in (15.29, 15.3, 29.9, 30, None, 101)] == ["Low", "Medium", "Medium", "High", "Unavailable", "Unavailable"]
    with pytest.raises(Exception, match="between 0 and 100"):
        c(101, strict=True)
    lots = [one(spark, classify.lot_size(F.lit(x).cast("double")))[0] for x in (None, 0, 399.99, 400, 800, 800.01)]
    assert lots == ["unknown", "unknown", "small", "medium", "medium", "large"]
    assert tuple(one(spark, classify.daily_mean_context(F.lit(38.0), F.lit(22.0)))[0])[:2] == ("At or above historical 30 C threshold", 30.0)


def test_ranges(spark):
    a, b = ranges.of(1, 2), ranges.of(0.5, 4)
    assert tuple(one(spark, ranges.multiply(a, b))[0]) == (0.5, 8) and one(spark, ranges.valid(b, True), ranges.valid(ranges.of(2, 1)), ranges.valid(a)) == (False, False, True)


SQUARE = "array(array(named_struct('x',0D,'y',0D),named_struct('x',4D,'y',0D),named_struct('x',4D,'y',4D),named_struct('x',0D,'y',4D),named_struct('x',0D,'y',0D)){})"
HOLE = ",array(named_struct('x',1D,'y',1D),named_struct('x',2D,'y',1D),named_struct('x',2D,'y',2D),named_struct('x',1D,'y',2D),named_struct('x',1D,'y',1D))"


def test_polygons(spark):
    p, q = F.expr(SQUARE.format("")), F.expr(SQUARE.format(HOLE))
    assert one(spark, geo.polygon_area(p), geo.polygon_area(q), geo.valid_polygon(q), geo.valid_polygon(F.expr("array(array(named_struct('x',0D,'y',0D)))"))) == (16, 15, True, False)
    inside = lambda poly, x, y: one(spark, geo.in_polygon(poly, F.lit(x), F.lit(y)))[0]
    assert [inside(q, x, y) for x, y in ((0.5, 0.5), (1.5, 1.5), (4.0, 2.0), (0.0, 0.0), (5.0, 1.0), (1.0, 1.5))] == [True, False, True, True, False, True]
    assert one(spark, geo.polygons_meet(p, geo.box_polygon(F.lit(3.0), F.lit(3.0), F.lit(9.0), F.lit(9.0))), geo.polygons_meet(p, geo.box_polygon(F.lit(5.0), F.lit(5.0), F.lit(9.0), F.lit(9.0)))) == (True, False)
    u = "array(array({}))".format(",".join(f"named_struct('x',{x}D,'y',{y}D)" for x, y in ((0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6), (0, 0))))
    at = one(spark, geo.interior_point(F.expr(u)))[0]
    assert one(spark, geo.in_polygon(F.expr(u), F.lit(at["x"]), F.lit(at["y"])))[0]
    ring = geo.clip_to_convex(p[0], geo.circle(F.lit(2.0), F.lit(2.0), F.lit(1.0))[0])
    assert abs(one(spark, geo.ring_area(ring))[0] - 24 / 2 * math.sin(2 * math.pi / 24)) < 1e-9
    assert one(spark, geo.distance_to_box(F.lit(7.0), F.lit(8.0), F.lit(0.0), F.lit(0.0), F.lit(4.0), F.lit(4.0)))[0] == 5
    assert one(spark, geo.repaired_area(F.lit(100.0), F.lit(150.0)), geo.repaired_area(F.lit(100.0), F.lit(100.9)), geo.cell_key(F.lit(1234.0), F.lit(-1.0), 500)) == (150, 100, "epsg7855:1000:-500:500")


def exact_grid(lon, lat):
    """The same projection from the meridian arc at a complex latitude, by Newton's method and quadrature."""
    import cmath

    import numpy as np

    f, a = 1 / 298.257222101, 6378137.0
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    iso = lambda p: cmath.atanh(cmath.sin(p)) - e * cmath.atanh(e * cmath.sin(p))
    goal, p = iso(math.radians(lat)) + 1j * math.radians(lon - 147), complex(math.radians(lat))
    for _ in range(50):
        p -= (iso(p) - goal) * (1 - e2 * cmath.sin(p) ** 2) * cmath.cos(p) / (1 - e2)
    t, w = np.polynomial.legendre.leggauss(60)
    arc = sum(wi * (p / 2) * a * (1 - e2) / (1 - e2 * cmath.sin(p / 2 * (ti + 1)) ** 2) ** 1.5 for ti, wi in zip(t, w))
    return 500000 + 0.9996 * arc.imag, 10000000 + 0.9996 * arc.real


def test_map_grid(spark):
    for lon, lat in ((147.0, -37.0), (144.96, -37.81), (149.5, -12.0), (147.5, 5.0)):
        x, y = one(spark, *geo.to_map_grid(F.lit(lon), F.lit(lat)))
        want = exact_grid(lon, lat)
        assert abs(x - want[0]) < 0.001 and abs(y - want[1]) < 0.001
    assert one(spark, *geo.web_tile(F.lit(0.0), F.lit(0.0), 1)) == (1, 1)
