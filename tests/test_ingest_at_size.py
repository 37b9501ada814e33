"""Ingest jobs over a small file of many rows: it is read by all tasks, and each row's properties are looked up once."""

import pytest
from pyspark.sql import functions as F

from greenlake.operators import quality
from greenlake.plans import adapters, jobs
from greenlake.sources import inventories


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_single_file_is_dealt_over_the_tasks(spark):
    one = adapters.load(spark, "/root/testdata/sf0.001", "customer").coalesce(1)
    many = adapters.dealt(one, "c_custkey")
    sizes = many.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(r["count"] for r in sizes) == one.count()
    assert adapters.dealt(many, "c_custkey") is many


def test_property_maps_are_made_once_a_row(spark):
    rows = spark.range(2).selectExpr("map('GCCSA Code 2021', CAST(id AS STRING), 'LGA_CODE', CAST(id AS STRING), 'LGA_NAME', 'Kew') AS properties", "'g' AS geometry", "1D AS measured_m2")
    assert plan(jobs._area(rows)).count("transform_keys") == 1
    assert plan(inventories.normalise_lga(rows)).count("transform_keys") == 1
    assert plan(inventories.normalise_melbourne_trees(rows)).count("regexp_replace") <= 2
    assert [tuple(r)[:3] for r in inventories.normalise_lga(rows).collect()] == [("0", "0", "Kew"), ("1", "1", "Kew")]


def test_a_change_keeps_its_own_period(spark):
    rows = spark.sql("SELECT map('unique_id', CAST(id AS STRING), 'Tree Change', '3') AS properties, IF(id = 9, NULL, 'g') AS geometry, make_date(2010 + id, 1, 1) AS observed_from, DATE'2018-01-01' AS observed_to FROM range(3)")
    x = jobs._change(rows.unionByName(rows.selectExpr("map('a', 'b') AS properties", "CAST(NULL AS STRING) AS geometry", "observed_from", "observed_to")))
    assert " Join " not in plan(x)
    assert sorted((r["source_feature_key"], r["observed_from"].year) for r in x.collect()) == [("mmb:0", 2010), ("mmb:1", 2011), ("mmb:2", 2012)]


@pytest.mark.parametrize("few", [0, 2, 1000])
def test_uniqueness_moves_hashes_not_rows(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW_REPEATS", few)
    stored, real = [], quality.written
    monkeypatch.setattr(quality, "written", lambda df, name, **o: stored.append(name) or real(df, name, **o))
    x = spark.sql("SELECT concat(IF(id % 2 = 0, ' K', 'k'), IF(id < 6, id DIV 2, id)) AS k, IF(id = 20, -0D, IF(id = 21, 0D, IF(id > 27, NULL, id + 1D))) AS v, concat('some longer text ', id) AS t FROM range(30)")
    rules = [{"code": "K", "type": "unique", "fields": ["k"]}, {"code": "V", "type": "unique", "fields": ["v"]}, {"code": "T", "type": "required", "fields": ["t", "v"]}]
    judged = quality.judge(x, rules, "d", 60.0)
    assert {(r["rule_code"], r["failed"]) for r in judged.report.collect()} == {("K", 6), ("V", 2), ("T", 2), (None, 10)} and judged.passed
    assert judged.kept().count() == 20 and judged.kept().columns == x.columns
    want = sorted((r["t"], r["_fail_0"], r["_fail_1"], r["_failed"]) for r in quality.with_failures(x, rules).collect())
    assert want == sorted((r["t"], r["_fail_0"], r["_fail_1"], r["_failed"]) for r in judged.marked.collect())
    assert stored.count("rows") == 1
    if few == 1000:
        # Nothing but the one table of rows is stored whole, and reading it shuffles nothing.
        assert stored == ["rows"] + ["repeated-hashes", "repeated-keys"] * 2
        assert "Exchange hashpartitioning" not in judged.marked._jdf.queryExecution().executedPlan().toString()
        assert not [c for c in judged.marked.columns if c.startswith("_key_")]
