"""Requests of one text are matched once."""

import duckdb
import pytest

from greenlake.operators import property
from greenlake.plans import queries as core


@pytest.fixture
def matched(monkeypatch):
    met, real = [], property.address_matches
    monkeypatch.setattr(property, "address_matches", lambda r, a, **rest: met.append(r.count()) or real(r, a, **rest))
    return met


def tables(spark):
    a = spark.range(30).selectExpr("id AS address_id", "concat('1 A ROAD ', id % 15) AS full_address", "IF(id % 2 = 0, 'Y', 'N') AS is_primary", "id AS parcel_id", "1D AS x", "1D AS y")
    r = spark.range(60).selectExpr("id AS request_id", "element_at(array('1 a rd', '1 A ROAD 7', '9', NULL), CAST(id % 4 AS INT) + 1) AS request")
    return r, a


def test_autocomplete_of_equal_requests(spark, matched):
    r, a = tables(spark)
    got = property.autocomplete(r, a, 3).orderBy("request_id", "rank").collect()
    # By id parity first, then by text: 0, 1 and 10 are the first texts.
    want = {0: [0, 16, 10], 1: [22, 7]}
    assert [(x["request_id"], x["address_id"], x["rank"]) for x in got] == [(i, n, k + 1) for i in range(60) for k, n in enumerate(want.get(i % 4, []))]
    assert matched == [4]


def test_resolve_of_equal_requests(spark, matched):
    r, a = tables(spark)
    got = {x["request_id"]: (x["status"], x["n_matches"], x["address_id"]) for x in property.resolve(r, a).collect()}
    assert got == {i: (("ambiguous", 30, None), ("resolved", 2, 7), ("no_match", 0, None), ("no_match", 0, None))[i % 4] for i in range(60)}
    assert matched == [4]


def test_membership_on_a_shared_edge(spark, tmp_path):
    """A tree on the line between two councils is one member."""
    duckdb.execute(f"copy (select 0::bigint l_orderkey, 0::bigint l_partkey, 48000::bigint l_suppkey, 1 l_linenumber, 1.0 l_quantity) to '{tmp_path}/lineitem.parquet'")
    duckdb.execute(f"copy (select 0::bigint p_partkey, 'a' p_name, 'b' p_brand) to '{tmp_path}/part.parquet'")
    duckdb.execute(f"copy (select 48000::bigint s_suppkey, 0 s_nationkey) to '{tmp_path}/supplier.parquet'")
    duckdb.execute(f"copy (select range::int n_nationkey, 'n' n_name from range(25)) to '{tmp_path}/nation.parquet'")
    q = core.registered()["membership"]
    with duckdb.connect() as c:
        for t in ("lineitem", "part", "supplier", "nation"):
            c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
        want = c.execute(q.sql).fetchall()
    assert [(r["version_id"], r["records"]) for r in q.run(spark, str(tmp_path)).collect()] == [(w[0], w[2]) for w in want] == [("clip|0", 1)]
