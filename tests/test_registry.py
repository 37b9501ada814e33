"""Every registered query runs at the smallest size and equals its SQL."""

import os

import duckdb
import pytest

from greenlake.plans import queries as core

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for f in os.listdir(D):
        c.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    return c


def shown(rows):
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(core.registered()))
def test_query(spark, tables, name):
    q = core.registered()[name]
    df = q.run(spark, D)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    if q.sql:
        r = tables.execute(q.sql)
        names = [d[0] for d in r.description]
        want = [tuple(x[names.index(c)] for c in columns) for x in r.fetchall()]
        assert shown(got) == shown(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
