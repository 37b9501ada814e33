import math
import random

import duckdb
import pytest

from greenlake.operators import property, spatial_join
from greenlake.plans import queries as core


def brute(centres, things, radius, k):
    """Each centre's k nearest within the radius; boxes have a distance of 0 inside."""
    out = []
    for c, cx, cy in centres:
        near = []
        for i, x0, y0, x1, y1 in things:
            dx, dy = max(x0 - cx, 0.0, cx - x1), max(y0 - cy, 0.0, cy - y1)
            if math.sqrt(dx * dx + dy * dy) <= radius:
                near.append((math.sqrt(dx * dx + dy * dy), str(i)))
        out += [(c, i, d, r + 1) for r, (d, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.mark.parametrize("k,boxes", [(1, False), (4, False), (40, False), (3, True)])
def test_nearest_within_a_radius(spark, k, boxes):
    rnd = random.Random(k)
    spot = [(500 + rnd.randrange(0, 12), 500 + rnd.randrange(0, 12)) for _ in range(300)]  # a third in one place, many at equal distances
    places = spot + [(rnd.randrange(-2000, 4000), rnd.randrange(-2000, 4000)) for _ in range(600)]
    w = (lambda: rnd.choice([0, 5, 60])) if boxes else (lambda: 0)
    things = [(i, float(x), float(y), float(x + w()), float(y + w())) for i, (x, y) in enumerate(places)]
    centres = [(i, float(x), float(y)) for i, (x, y) in enumerate(rnd.sample(spot, 20) + [(rnd.randrange(-2500, 4500), rnd.randrange(-2500, 4500)) for _ in range(40)] + [(9000, 9000)])]
    c = spark.createDataFrame(centres + [(99, None, 1.0)], "centre_id long, cx double, cy double")
    t = spark.createDataFrame(things + [(9999, None, 1.0, None, None)], "id long, xmin double, ymin double, xmax double, ymax double")
    t = t if boxes else t.selectExpr("id", "xmin AS x", "ymin AS y")
    got = property.environment_context(c, {"layer": t}, 700.0, k).select("centre_id", "id", "distance_m", "rank").collect()
    want = brute(centres, things, 700.0, k)
    assert [(a, b, pytest.approx(d), r) for a, b, d, r in want] == sorted(map(tuple, got))
    if not boxes and k == 4:
        whole = sum(math.dist((cx, cy), (x, y)) <= 700 for _, cx, cy in centres for _, x, y, _, _ in things)
        assert spark.createDataFrame([(spatial_join.near_pairs(c, t, 700.0, k).count(),)], "n long").first()["n"] < whole / 4


def test_named_trees(spark):
    trees = spark.createDataFrame([(1, 0.0, 0.0, "Elm"), (2, 30.0, 40.0, "Oak"), (3, 500.0, 0.0, "Ash")], "id long, x double, y double, common_name string")
    centres = spark.createDataFrame([(7, 0.0, 0.0)], "centre_id long, cx double, cy double")
    rows = property.named_trees_near(centres, trees).orderBy("rank").collect()
    assert [(r["common_name"], r["distance_m"], r["rank"]) for r in rows] == [("Elm", 0.0, 1), ("Oak", 50.0, 2)]
    with pytest.raises(ValueError):
        property.named_trees_near(centres, trees, 3000.0)


def test_many_of_one_place(spark):
    """Copies of a centre share its answer, and a place holds no more things than can be in one."""
    c = spark.range(40).selectExpr("id AS centre_id", "CAST(id % 2 * 100 AS DOUBLE) AS cx", "0D AS cy")
    t = spark.range(3000).selectExpr("id", "CAST(id % 3 * 30 AS DOUBLE) AS x", "0D AS y")
    near = spatial_join.near_pairs
    made = []
    spatial_join.near_pairs = lambda centres, things, *rest: made.append((centres.count(), things.count())) or near(centres, things, *rest)
    try:
        got = property.environment_context(c, {"layer": t}, 500.0, 4).orderBy("centre_id", "rank").collect()
    finally:
        spatial_join.near_pairs = near
    firsts = {0: sorted((str(i) for i in range(0, 3000, 3)))[:4], 1: sorted(str(i) for i in range(2, 3000, 3))[:4]}
    assert [(r["centre_id"], r["id"]) for r in got] == [(i, x) for i in range(40) for x in firsts[i % 2]]
    assert made == [(2, 12)]


def test_counts_around_centres(spark, monkeypatch):
    """All things within the radius are counted, as brute force does; copies of places meet once."""
    rnd = random.Random(9)
    places = [(rnd.randrange(0, 2500), rnd.randrange(0, 2500)) for _ in range(150)]
    things = [(i, x, y, x + w, y + w) for i, (x, y) in enumerate(places * 3) for w in [x % 3 * 700]]
    centres = [(i, x, y) for i, (x, y) in enumerate(places[:40] * 2)] + [(90, -700, 0), (91, 3000, 5000), (91, 0, 0)]
    c = spark.createDataFrame(centres + [(99, None, 1)], "centre_id long, cx long, cy long")
    boxes = spark.createDataFrame(things + [(999, None, 1, 2, 3)], "id long, xmin long, ymin long, xmax long, ymax long")
    area = spark.createDataFrame([(-1000, -1000, 1500, 1500), (-1000, -1000, 1000, 5000), (2900, 4900, 3100, 5100)], "xmin long, ymin long, xmax long, ymax long")
    inside = [r for r in centres if (r[1] <= 1500 and r[2] <= 1500) or r[1] <= 1000 or r[0] == 91]
    flat = [(i, x, y, x, y) for i, x, y, _, _ in things]
    made = []
    for name in ("within_radius", "boxes_within_radius"):
        real = getattr(spatial_join, name)
        monkeypatch.setattr(spatial_join, name, lambda a, b, *rest, real=real: made.append((a.count(), b.count())) or real(a, b, *rest))
    layers = {"boxes": boxes, "points": boxes.selectExpr("id", "xmin AS x", "ymin AS y")}
    for boundary, asked in ((None, centres), (area, inside)):
        made.clear()
        got = property.environment_counts(c, layers, 700.0, boundary).collect()
        want = []
        for layer, of in (("boxes", things), ("points", flat)):
            for i, x, y in asked:
                want += [(i, layer, n) for n in [len(brute([(i, x, y)], of, 700, 10**6))] if n]
        assert sorted(map(tuple, got)) == sorted(want)
        spots = len({r[1:] for r in asked})
        assert made == [(spots + (boundary is None), len(set(places)) + 1), (spots + (boundary is None), len(set(places)) + 1)]
    near = property.environment_context(c, layers, 700.0, 2000, area).groupBy("centre_id", "layer").count().collect()
    assert {(r[0], r[1]): r[2] for r in near if r[0] != 91} == {(i, layer): n for i, layer, n in want if i != 91}
    with pytest.raises(ValueError):
        property.environment_counts(c, layers, 2001.0)


def test_context_counts_more_than_a_list_holds(spark, tmp_path):
    """The query equals its SQL where more parcels lie around a centre than the lists of a context may hold."""
    c = duckdb.connect()
    c.execute("create table customer as select i * 60000 as c_custkey from range(2100) a(i) union all select i from range(1, 900) a(i)")
    c.execute("create view nation as from '/root/testdata/sf0.001/nation.parquet'")
    for t in ("customer", "nation"):
        c.execute(f"copy {t} to '{tmp_path}/{t}.parquet'")
    q = core.registered()["context_within_boundary"]
    want = sorted(c.execute(q.sql).fetchall())
    assert max(n for _, n in want) > 2000
    assert sorted(map(tuple, q.run(spark, str(tmp_path)).collect())) == want
