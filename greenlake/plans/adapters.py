"""Logical tables over the test data, as SQL that Spark and DuckDB both run.

The test tables hold no geometry; places are derived by integer arithmetic, so both engines see the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLACE = "(l_orderkey * 31 + l_partkey * 17 + l_suppkey)"

#: name -> (source tables, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "parcel": (("customer",), """
        SELECT c_custkey AS parcel_id, (c_custkey * 7919) % 60000 AS x, (c_custkey * 104729) % 60000 AS y,
               (c_custkey * 7919) % 60000 - (8 + c_custkey % 20) AS xmin, (c_custkey * 104729) % 60000 - (8 + c_custkey % 20) AS ymin,
               (c_custkey * 7919) % 60000 + (8 + c_custkey % 20) AS xmax, (c_custkey * 104729) % 60000 + (8 + c_custkey % 20) AS ymax,
               4 * (8 + c_custkey % 20) * (8 + c_custkey % 20) AS area_m2
        FROM customer"""),
    "address": (("customer", "nation"), """
        SELECT c_custkey AS address_id, c_custkey AS parcel_id, concat(CAST(c_custkey % 200 AS VARCHAR(9)), ' ', c_mktsegment, ' ROAD ', n_name) AS full_address,
               CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS is_primary, (c_custkey * 7919) % 60000 AS x, (c_custkey * 104729) % 60000 AS y
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "lga": (("nation",), """
        SELECT n_nationkey AS lga_id, n_name AS lga_name, (n_nationkey % 5) * 12000 AS xmin, CAST(floor(n_nationkey / 5) AS BIGINT) * 12000 AS ymin,
               (n_nationkey % 5) * 12000 + 12000 AS xmax, CAST(floor(n_nationkey / 5) AS BIGINT) * 12000 + 12000 AS ymax, 144000000 + n_nationkey AS area_m2
        FROM nation"""),
    "weather": (("events",), """
        SELECT event_id AS observation_id, user_id % 40 AS station_code, (user_id % 40) * 1511 % 60000 AS x, (user_id % 40) * 2503 % 60000 AS y,
               ts AS observed_at, value / 10 AS air_temperature_c
        FROM events"""),
    "heat": (("lineitem",), """
        SELECT l_partkey % 500 AS cell_id, CAST(l_shipdate AS DATE) AS observed_on, l_extendedprice / 2000 AS heat_value, l_suppkey AS source_scene_id
        FROM lineitem"""),
    "tree": (("lineitem", "part", "supplier"), f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name AS scientific_name, p_brand AS common_name, nullif(l_quantity, 7) AS height_m,
               s_nationkey AS municipality_id, {PLACE} * 7919 % 60000 AS x, {PLACE} * 104729 % 60000 AS y, l_quantity / 10 AS radius
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""),
    "urban_tree": (("lineitem",), f"""
        SELECT {PLACE} * 7919 % 60000 AS x, {PLACE} * 104729 % 60000 AS y, l_quantity / 10 AS radius FROM lineitem"""),
    "version": (("orders",), """
        SELECT o_orderkey AS version_id, o_custkey AS source_id, CAST(o_orderdate AS DATE) AS extracted_at,
               CASE o_orderstatus WHEN 'F' THEN 'retired' WHEN 'O' THEN 'integrated' ELSE 'running' END AS integration_status
        FROM orders"""),
    "cost": (("part",), """
        SELECT p_partkey AS cost_id, CASE p_partkey % 4 WHEN 0 THEN 'backyard_tree_diy' WHEN 1 THEN 'backyard_tree_installed' WHEN 2 THEN 'garden_bed' ELSE 'green_wall' END AS option_code,
               p_name AS botanical_name, p_brand AS tree_type, p_retailprice AS minimum_cost, p_retailprice * 1.2 AS maximum_cost, p_type AS source_name,
               CAST('2024-01-01' AS DATE) AS valid_from, CASE WHEN p_size % 3 = 0 THEN CAST('2024-02-01' AS DATE) WHEN p_size % 3 = 1 THEN CAST('2024-12-31' AS DATE) END AS valid_to,
               CASE WHEN p_size % 5 = 0 THEN 'exact_listed_size_price' ELSE 'unmapped' END AS size_price_status
        FROM part"""),
    "pixel": (("lineitem",), f"""
        SELECT {PLACE} * 7919 % 60000 AS x, {PLACE} * 104729 % 60000 AS y, CASE WHEN l_linenumber = 7 THEN 255 ELSE l_linenumber % 2 END AS value,
               CASE l_linenumber WHEN 1 THEN 111 WHEN 2 THEN 112 WHEN 3 THEN 124 WHEN 4 THEN 215 WHEN 5 THEN 216 WHEN 6 THEN 220 ELSE 255 END AS class,
               l_partkey % 8 AS tile_id, 40000 + l_suppkey * 37 AS dn, CASE WHEN l_linenumber > 3 THEN 64 ELSE l_linenumber END AS qa
        FROM lineitem"""),
}


#: A table of more rows is not broadcast to the first of a logical table: its file, of packed columns, says little of its size in memory.
MOST_BROADCAST = 100_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A logical table, or one of the given tables by its own name."""
    if name not in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables, sql = TABLES[name]
    given = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables[1:]:
        if given[t].count() > MOST_BROADCAST:
            given[t] = given[t].hint("shuffle_hash")
    return spark.sql(" ".join(_named(sql, tables).split()), **given)


def dealt(given: DataFrame, key: str) -> DataFrame:
    """A given table dealt over as many tasks as there are cores at least: a packed file of many rows is a single task's to read."""
    n = given.sparkSession.sparkContext.defaultParallelism
    return given.repartition(n, key) if given.rdd.getNumPartitions() < n else given


def _named(sql: str, tables: tuple[str, ...]) -> str:
    """The statement with its tables as parameters, so no view is left behind in the session."""
    import re

    for t in tables:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", sql)
    return sql


def oracle(sql: str, *names: str) -> str:
    """A DuckDB statement over logical tables: each becomes a common table expression."""
    parts = ", ".join(f"{n} AS ({TABLES[n][1].strip()})" for n in names)
    return f"WITH {parts}{', ' if 'WITH ' == sql.lstrip()[:5] else ' '}{sql.lstrip()[5:] if 'WITH ' == sql.lstrip()[:5] else sql}"
