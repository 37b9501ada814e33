import random

import pytest

from greenlake.operators import property, species, versions


@pytest.mark.parametrize(
    ("text", "unit"),
    [("Unit 3, 5 A Road", True), (" apt 2", True), ("FLAT 1", True), ("3/12 High St", True), ("3 /12", True), ("12 Unity Street", False), ("12 High St", False), ("A / B", False), ("", False), (None, False)],
)
def test_unit_requests(spark, text, unit):
    assert spark.createDataFrame([(text,)], "t string").select(property.wants_unit("t")).first()[0] is unit


def test_parcel_of_a_place(spark):
    lots = spark.createDataFrame([(1, 4.0, 0.0, 0.0, 2.0, 2.0), (2, 100.0, 0.0, 0.0, 10.0, 10.0), (3, 100.0, 0.0, 0.0, 10.0, 10.0)], "parcel_id long, area_m2 double, xmin double, ymin double, xmax double, ymax double")
    asked = spark.createDataFrame([(1, "Unit 1", 1.0, 1.0), (2, "1 A St", 1.0, 1.0), (3, None, 1.0, 1.0), (4, "1 A St", 50.0, 1.0), (5, "x", None, None)], "request_id long, request string, x double, y double")
    found = lambda **k: {r["request_id"]: r["parcel_id"] for r in property.parcel_at(asked, lots, **k).collect()}
    assert found() == {1: 1, 2: 2, 3: 2, 4: None, 5: None}
    assert found(precise=True) == {1: 1, 2: 1, 3: 1, 4: None, 5: None}


def test_accepted_taxa(spark):
    rows = [
        ("Acer rubrum", "EXACT", 95, "species", "Acer rubrum"), ("acer x", "EXACT", 99, "SPECIES", "Acer × freemanii"), ("a", "EXACT", 94, "SPECIES", "Acer rubrum"),
        ("b", "FUZZY", 99, "SPECIES", "Acer rubrum"), ("c", "EXACT", 99, "GENUS", "Acer rubrum"), ("d", "EXACT", 99, "SPECIES", "Acer"), ("e", "EXACT", 99, None, "Acer rubrum"), ("a ", "EXACT", 99, "SPECIES", "Acer rubrum"),
    ]
    m = spark.createDataFrame(rows, "scientific_name string, match_type string, match_confidence int, taxon_rank string, matched_scientific_name string")
    assert {r["species_key"] for r in species.accepted_taxa(m).collect()} == {"acer rubrum", "acer x", "a"}


def test_superseded_versions_against_all_pairs(spark):
    rnd = random.Random(3)
    v = [(i, i % 3, rnd.randrange(0, 4), rnd.randrange(4, 8), i) for i in range(18)]
    facts = {i: {k: rnd.choice([None, 1, 2]) for k in rnd.sample(range(6), rnd.randrange(1, 6))} for i, *_ in v}
    for i in range(0, 18, 4):  # some are held by a later one of their source, all but for a null
        facts[(i + 3) % 18] = {**facts[(i + 3) % 18], **facts[i]}
    versions_df = spark.createDataFrame(v, "version_id int, source_id int, observed_from int, observed_to int, extracted_at int")
    f = spark.createDataFrame([(i, k, x) for i, m in facts.items() for k, x in m.items()], "version_id int, k int, x int")
    want = {}
    for i, s, lo, hi, _ in v:
        best = [(hi2, at, j) for j, s2, lo2, hi2, at in v if s2 == s and j != i and lo2 <= lo and hi2 >= hi and (lo2 < lo or hi2 > hi) and all(k in facts[j] and facts[j][k] == x for k, x in facts[i].items())]
        if best:
            want[i] = max(best)[2]
    got = {r["partial"]: r["complete"] for r in versions.superseded(versions_df, f, ["x"], ["k"]).collect()}
    assert got == want and want


def test_copies_of_versions_are_compared_once(spark, monkeypatch):
    """A thousand versions alike make no pairs of their own; a null tells facts apart, and the newest of a class holds."""
    stored = []
    monkeypatch.setattr(versions, "written", lambda df, name, **_: stored.append((name, df.cache())) or stored[-1][1])
    v = [(i, 0, 0, 1 + i % 2, 0) for i in range(1000)] + [(1000, 0, 0, 1, 0), (1001, 0, 0, 9, 0)]
    f = [(i, k, 1) for i in range(1000) for k in range(3)] + [(1000, None, 1), (1000, 1, 1), (1000, 2, 1), (1001, 1, None), (1001, 2, 1), (1001, 0, 1)]
    x = versions.superseded(spark.createDataFrame(v, "version_id int, source_id int, observed_from int, observed_to int, extracted_at int"), spark.createDataFrame(f, "version_id int, k int, x int"), ["x"], ["k"])
    assert {(r["partial"], r["complete"]) for r in x.collect()} == {(i, 999) for i in range(0, 1000, 2)}
    assert dict(stored)["facts"].count() == 12  # of two classes of copies and two single versions


def test_popularity_tells_sources(spark):
    t = spark.createDataFrame([("1", "Kew", "Acer rubrum", "Maple", 2.0, 3.0, "b", "CC"), ("1", "Kew", "Acer rubrum", "Maple", 4.0, 5.0, "a", " "), ("1", "Kew", "Acer rubrum", "Maple", 4.0, None, "a", None)],
                              "lga_code string, municipality string, scientific_name string, common_name string, height_m double, canopy_width_m double, source_name string, licence string")
    r = species.popularity(t, spark.createDataFrame([("1", "Kew")], "lga_code string, lga_name string")).first()
    assert r["source_names"] == ["a", "b"] and r["licences"] == ["CC"] and r["median_canopy_width_m"] == 4.0 and r["median_height_m"] == 4.0
