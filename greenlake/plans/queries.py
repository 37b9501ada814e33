"""Registered queries over the given tables, each with the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenlake.functions import classify, geo, text
from greenlake.operators import grid, growth, linkage, property, quality, raster, scenarios, spatial_join, species, versions, weather
from greenlake.plans import pipelines
from greenlake.plans.adapters import load, oracle
from greenlake.sources import inventories
from greenlake.streaming import weather as weather_stream

AS_OF = "2024-01-15 12:00:00"
_SPARK = {"l": "CAST({0} AS BIGINT)", "s": "CAST({0} AS STRING)", "d": "floor(CAST({0} AS DOUBLE) * 100000D + 0.50017D) / 100000D", "t": "CAST({0} AS DATE)", "b": "{0}"}
_DUCK = {"l": "CAST({0} AS BIGINT)", "s": "CAST({0} AS VARCHAR)", "d": "floor(CAST({0} AS DOUBLE) * 100000 + 0.50017) / 100000", "t": "CAST({0} AS DATE)", "b": "{0}"}


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(columns: str, sql: str | None = None, tables: str = ""):
    """Register a function under its name.

    ``columns`` gives the result's columns as ``name:kind``; both engines cast to them, and doubles are
    rounded alike. ``sql`` reads the logical ``tables``.
    """
    pairs = [c.strip().split(":") for c in columns.split(",")]

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda name: load(spark, sf_dir, name)).selectExpr(*(f"{_SPARK[k].format(f'`{c}`')} AS `{c}`" for c, k in pairs))

        said = None
        if sql:
            cast = ", ".join(f"{_DUCK[k].format(c)} AS {c}" for c, k in pairs)
            said = oracle(f"WITH _result AS ({sql}) SELECT {cast} FROM _result", *tables.split()) if tables else f"WITH _result AS ({sql}) SELECT {cast} FROM _result"
        QUERIES[fn.__name__] = Query(run, said)
        return fn

    return register


def _band(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'Unavailable' WHEN {x} <= 27 THEN 'Low' WHEN {x} <= 30 THEN 'Medium' ELSE 'High' END"


def _canopy(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'Unavailable' WHEN {x} >= 30 THEN 'High' WHEN {x} >= 15.3 THEN 'Medium' ELSE 'Low' END"


# -- heat and grids -------------------------------------------------------------------------------------------------


@query("cell_id:l, observed_on:t, heat_value:d, min_value:d, max_value:d, n_values:l, n_scenes:l, scenes:s", """
    SELECT cell_id, observed_on, avg(heat_value) heat_value, min(heat_value) min_value, max(heat_value) max_value, count(*) n_values,
           count(DISTINCT source_scene_id) n_scenes, array_to_string(list_sort(list(DISTINCT source_scene_id)), ',') scenes
    FROM heat GROUP BY ALL""", "heat")  # fmt: skip
def heat_daily(t):
    return grid.heat_daily(t("heat")).withColumn("scenes", F.array_join(F.col("source_scene_ids").cast("array<string>"), ","))


@query("cell_id:l, observed_on:t, heat_value:d, n_values:l, n_scenes:l, spread:d, band:s", f"""
    SELECT cell_id, observed_on, avg(heat_value) heat_value, count(*) n_values, count(DISTINCT source_scene_id) n_scenes,
           max(heat_value) - min(heat_value) spread, {_band('avg(heat_value)')} band
    FROM heat h WHERE observed_on = (SELECT max(observed_on) FROM heat g WHERE g.cell_id = h.cell_id) GROUP BY cell_id, observed_on""", "heat")  # fmt: skip
def heat_mosaic(t):
    return grid.heat_mosaic(t("heat")).withColumn("band", classify.temperature_band("heat_value"))


@query("lat:l, lon:l, observed_on:t, air_temperature_mean_c:d, air_temperature_min_c:d, air_temperature_max_c:d, precipitation_total_mm:d, soil_water_layer_1_mean_m3_m3:d, surface_solar_radiation_total_mj_m2:d, wind_speed_mean_ms:d, hour_count:l", """
    WITH h AS (SELECT user_id % 5 lat, user_id % 7 lon, date_trunc('hour', ts) ts, CASE WHEN user_id % 2 = 0 THEN value + 273.15 ELSE value END t2m, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 1000 END tp,
                      value / 500 swvl1, value * 1000000 ssrd, value u10, value / 2 v10 FROM events),
    g AS (SELECT lat, lon, CAST(ts AS DATE) observed_on, quantile_cont(t2m, 0.5) m, avg(t2m) a, min(t2m) lo, max(t2m) hi, sum(tp) p, avg(swvl1) s, sum(ssrd) r, avg(sqrt(u10 * u10 + v10 * v10)) w, count(DISTINCT ts) n FROM h GROUP BY ALL)
    SELECT lat, lon, observed_on, a - CASE WHEN m > 150 THEN 273.15 ELSE 0 END air_temperature_mean_c, lo - CASE WHEN m > 150 THEN 273.15 ELSE 0 END air_temperature_min_c,
           hi - CASE WHEN m > 150 THEN 273.15 ELSE 0 END air_temperature_max_c, coalesce(p, 0) * 1000 precipitation_total_mm, s soil_water_layer_1_mean_m3_m3,
           coalesce(r, 0) / 1e6 surface_solar_radiation_total_mj_m2, w wind_speed_mean_ms, n hour_count FROM g""")  # fmt: skip
def daily_grid(t):
    h = t("events").selectExpr(
        "user_id % 5 AS lat", "user_id % 7 AS lon", "date_trunc('hour', ts) AS ts", "CASE WHEN user_id % 2 = 0 THEN value + 273.15D ELSE value END AS t2m",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value / 1000 END AS tp", "value / 500 AS swvl1", "value * 1000000 AS ssrd", "value AS u10", "value / 2 AS v10",
    )
    return grid.daily_from_hourly(h)


@query("taxon_name:s, trait_name:s, n:l, n_numeric:l, min_value:d, max_value:d, median_value:d", """
    SELECT p_name taxon_name, p_type trait_name, count(*) n, count(nullif(p_size, 7)) n_numeric, min(nullif(p_size, 7)) min_value, max(nullif(p_size, 7)) max_value,
           quantile_cont(nullif(p_size, 7), 0.5) median_value FROM part GROUP BY ALL""")  # fmt: skip
def trait_summary(t):
    return grid.trait_summary(t("part").selectExpr("p_name AS taxon_name", "p_type AS trait_name", "CAST(nullif(p_size, 7) AS DOUBLE) AS value_numeric"))


@query("lower:d, upper:d, samples:l", "SELECT quantile_cont(heat_value, 1.0::DOUBLE / 3) AS lower, quantile_cont(heat_value, 2.0::DOUBLE / 3) AS upper, count(heat_value) samples FROM heat", "heat")
def tercile_thresholds(t):
    return grid.tercile_thresholds(t("heat"), "heat_value")


@query("metric:s, band:s, n:l", f"""
    SELECT 'temperature' metric, {_band('heat_value')} band, count(*) n FROM heat GROUP BY ALL
    UNION ALL SELECT 'canopy', {_canopy('heat_value')}, count(*) FROM heat GROUP BY ALL""", "heat")  # fmt: skip
def class_distribution(t):
    return grid.class_distribution(t("heat"), {"temperature": classify.temperature_band("heat_value"), "canopy": classify.canopy_band("heat_value")})


@query("o_custkey:l, year:l, status:s, source_occurrence_count:l, variant_number:l, ambiguous:b", """
    WITH x AS (SELECT o_custkey, year(o_orderdate) AS "year", nullif(o_orderstatus, 'P') status, count(*) source_occurrence_count FROM orders GROUP BY ALL)
    SELECT *, row_number() OVER (PARTITION BY o_custkey, "year" ORDER BY status NULLS FIRST) variant_number, count(*) OVER (PARTITION BY o_custkey, "year") > 1 ambiguous FROM x""")  # fmt: skip
def climate_variants(t):
    x = t("orders").selectExpr("o_custkey", "year(o_orderdate) AS year", "nullif(o_orderstatus, 'P') AS status")
    return grid.climate_variants(x, ["o_custkey", "year"], ["status"])


@query("source_row_number:l, ring_sequence:l", """
    SELECT o_orderkey source_row_number, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus, CASE WHEN o_custkey % 50 = 0 THEN -1 ELSE o_custkey % 50 END ORDER BY o_orderkey) ring_sequence FROM orders""")
def ring_sequence(t):
    return grid.ring_sequence(t("orders").selectExpr("o_orderpriority AS city", "o_orderstatus AS species_name", "CAST(o_custkey % 50 AS INT) AS tree_number", "o_orderkey AS source_row_number"))


@query("scientific_name:s, height_m:d, radius:d, common_name:s", """
    WITH m AS (SELECT scientific_name, common_name, count(*) n FROM tree GROUP BY ALL),
    b AS (SELECT scientific_name, common_name, row_number() OVER (PARTITION BY scientific_name ORDER BY n DESC, common_name) r FROM m)
    SELECT t.scientific_name, quantile_cont(height_m, 0.5) height_m, quantile_cont(radius, 0.5) radius, min(b.common_name) common_name
    FROM tree t JOIN b ON b.scientific_name = t.scientific_name AND r = 1 GROUP BY t.scientific_name""", "tree")  # fmt: skip
def species_profile(t):
    return grid.profile(t("tree"), "scientific_name", ["height_m", "radius"], ["common_name"])


@query("vx:l, vy:l, n_trees:l, canopy_m2:d, canopy_pct:d", """
    SELECT floor(x / 5000) vx, floor(y / 5000) vy, count(*) n_trees, sum(pi() * radius * radius) canopy_m2, sum(pi() * radius * radius) / 25000000 * 100 canopy_pct FROM urban_tree GROUP BY 1, 2""", "urban_tree")
def canopy_by_view(t):
    return grid.canopy_by_view(t("urban_tree"), 5000.0)


# -- quality --------------------------------------------------------------------------------------------------------

RULES = [
    {"code": "REQUIRED", "type": "required", "fields": ["returnflag", "quantity"]},
    {"code": "UNIQUE", "type": "unique", "fields": ["orderkey", "linenumber"]},
    {"code": "RANGE", "type": "range", "field": "quantity", "minimum": 2, "maximum": 45, "inclusive_minimum": False},
    {"code": "ALLOWED", "type": "allowed", "field": "returnflag", "values": ["a", "N"]},
    {"code": "ORDER", "type": "field_order", "lower_field": "discount", "upper_field": "tax"},
]
_MARKED = """
    WITH r AS (SELECT l_orderkey orderkey, l_linenumber linenumber, nullif(l_returnflag, 'R') returnflag, nullif(l_quantity, 7) quantity, l_discount discount, l_tax tax FROM lineitem),
    m AS (SELECT *, returnflag IS NULL OR quantity IS NULL f0, count(*) OVER (PARTITION BY orderkey, linenumber) > 1 f1, coalesce(NOT (quantity > 2 AND quantity <= 45), true) f2,
                 NOT coalesce(lower(returnflag) IN ('a', 'n'), false) f3, discount > tax f4 FROM r)"""


def _records(t):
    return t("lineitem").selectExpr("l_orderkey AS orderkey", "l_linenumber AS linenumber", "nullif(l_returnflag, 'R') AS returnflag", "nullif(l_quantity, 7) AS quantity", "l_discount AS discount", "l_tax AS tax")


@query("rule_code:s, rule_type:s, assessed:l, passed:l, failed:l, pass_rate:d, passed_gate:b", _MARKED + """,
    c AS (SELECT count(*) n, [count_if(f0), count_if(f1), count_if(f2), count_if(f3), count_if(f4), count_if(f0 OR f1 OR f2 OR f3 OR f4)] f FROM m),
    u AS (SELECT n, unnest(f) failed, unnest(['REQUIRED', 'UNIQUE', 'RANGE', 'ALLOWED', 'ORDER', NULL]) rule_code, unnest(['required', 'unique', 'range', 'allowed', 'field_order', 'all']) rule_type FROM c)
    SELECT rule_code, rule_type, n assessed, n - failed passed, failed, round((n - failed) / n * 100, 2) pass_rate, (n - failed) / n * 100 >= 95 passed_gate FROM u""")  # fmt: skip
def quality_report(t):
    return quality.validate(_records(t), RULES, "lineitem")


@query("orderkey:l, n:l", _MARKED + """, k AS (SELECT * FROM m WHERE NOT (f1 OR f2))
    SELECT orderkey, count(*) n FROM k WHERE (SELECT count_if(NOT (f1 OR f2)) / count(*) * 100 FROM m) >= 10 GROUP BY ALL""")
def quality_gate(t):
    return quality.gate(_records(t), [RULES[1], RULES[2]], 10.0).groupBy("orderkey").agg(F.count("*").alias("n"))


@query("rule_code:s, dimension:s, failed:l, status:s, sample_ids:s", _MARKED + """,
    f AS (SELECT 'REQUIRED' rule_code, orderkey FROM m WHERE f0 UNION ALL SELECT 'RANGE', orderkey FROM m WHERE f2),
    s AS (SELECT rule_code, orderkey, row_number() OVER (PARTITION BY rule_code ORDER BY orderkey) r FROM f)
    SELECT rule_code, CASE rule_code WHEN 'REQUIRED' THEN 'completeness' ELSE 'validity' END dimension, count(*) failed, 'failed' status,
           string_agg(CAST(orderkey AS VARCHAR), ',' ORDER BY orderkey) FILTER (WHERE r <= 20) sample_ids FROM s GROUP BY rule_code""")  # fmt: skip
def quality_evidence(t):
    return quality.evidence(_records(t), [RULES[0], RULES[2]], "orderkey")


@query("records:l, required_rate:d, range_rate:d, unique_rate:d, overall_rate:d", """
    WITH r AS (SELECT count(*) n, count_if(heat_value IS NOT NULL AND cell_id IS NOT NULL) / count(*) * 100 a, count_if(heat_value BETWEEN 5 AND 40) / count(*) * 100 b,
                      count(DISTINCT (cell_id, observed_on)) / count(*) * 100 c FROM heat)
    SELECT n records, round(a, 2) required_rate, round(b, 2) range_rate, round(c, 2) unique_rate, round(least(a, b, c), 2) overall_rate FROM r""", "heat")  # fmt: skip
def baseline_checks(t):
    return quality.baseline_checks(t("heat"), ["cell_id", "observed_on"], ["heat_value", "cell_id"], "heat_value", 5, 40)


@query("overlap_pct:d", """
    WITH a AS (SELECT min(xmin) x0, min(ymin) y0, max(xmax) x1, max(ymax) y1 FROM lga), b AS (SELECT min(xmin) x0, min(ymin) y0, max(xmax) x1, max(ymax) y1 FROM parcel)
    SELECT least(100, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) / ((a.x1 - a.x0) * (a.y1 - a.y0)) * 100) overlap_pct FROM a, b""", "lga parcel")  # fmt: skip
def grid_alignment(t):
    return quality.grid_alignment(t("lga"), t("parcel"))


# -- text -----------------------------------------------------------------------------------------------------------


@query("conv_id:l, turn:l, cleaned:s", r"""
    SELECT conv_id, turn, CASE WHEN lower(c) NOT IN ('', '-', 'n/a', 'na', 'none', 'null', 'unknown', 'not applicable', 'not appliable', 'not specified', 'to be determined', 'tbd') THEN c END cleaned
    FROM (SELECT conv_id, turn, trim(regexp_replace(CASE WHEN turn % 7 = 3 THEN ' Unknown ' ELSE text END, '\s+', ' ', 'g')) c FROM conversations)""")  # fmt: skip
def clean_text(t):
    return t("conversations").select("conv_id", "turn", text.clean(F.expr("CASE WHEN turn % 7 = 3 THEN ' Unknown ' ELSE text END")).alias("cleaned"))


@query("o_orderkey:l, low:d, high:d, price:d", """
    SELECT o_orderkey, CAST(least(nullif(o_orderkey % 50, 0), o_custkey + 0.5) AS DOUBLE) low, CAST(greatest(nullif(o_orderkey % 50, 0), o_custkey + 0.5) AS DOUBLE) high,
           CASE WHEN o_totalprice > 0 THEN o_totalprice END price FROM orders""")  # fmt: skip
def numeric_range(t):
    x = t("orders").withColumn("s", F.expr("concat('about ', o_orderkey % 50, ' to ', o_custkey, '.5 m')"))
    r = text.numeric_range("s")
    return x.select("o_orderkey", r["minimum"].alias("low"), r["maximum"].alias("high"), text.positive_float(F.format_number("o_totalprice", 2)).alias("price"))


@query("c_custkey:l, id:s", "SELECT c_custkey, 'casey:' || substr(sha256(c_name || '|' || coalesce(CAST(nullif(c_nationkey, 3) AS VARCHAR), '') || '|' || trim(c_mktsegment)), 1, 32) id FROM customer")
def stable_id(t):
    return t("customer").select("c_custkey", text.stable_id("casey", "c_name", F.expr("nullif(c_nationkey, 3)"), "c_mktsegment").alias("id"))


@query("p_partkey:l, name:s, precision:s", """
    WITH x AS (SELECT p_partkey, split_part(p_name, ' ', 1) g, CASE p_size % 4 WHEN 0 THEN 'sp.' WHEN 1 THEN p_name WHEN 2 THEN 'A. ' || split_part(p_name, ' ', 2) ELSE NULL END s FROM part)
    SELECT p_partkey, CASE WHEN s IS NULL OR s = 'sp.' THEN g || ' sp.' WHEN starts_with(s, g || ' ') THEN s ELSE g || ' ' || regexp_replace(s, '^[A-Za-z]\\.\\s*', '') END AS name,
           CASE WHEN s IS NULL OR s = 'sp.' THEN 'genus' ELSE 'species' END "precision" FROM x""".replace("\\\\", "\\"))  # fmt: skip
def scientific_names(t):
    x = t("part").withColumns({"g": F.expr("split_part(p_name, ' ', 1)"), "s": F.expr("CASE p_size % 4 WHEN 0 THEN 'sp.' WHEN 1 THEN p_name WHEN 2 THEN concat('A. ', split_part(p_name, ' ', 2)) END")})
    n = text.scientific_name("g", "s")
    return x.select("p_partkey", n["name"].alias("name"), n["precision"].alias("precision"))


@query("c_custkey:l, address:s, council:s", r"""
    SELECT c_custkey, upper(trim(regexp_replace(concat(c_custkey % 90, '  ', c_mktsegment, ' ROAD n', c_nationkey), '\s+', ' ', 'g'))) address, 'NATION_' || c_nationkey council FROM customer""")
def address_normalize(t):
    x = t("customer").withColumns({"a": F.expr("concat(c_custkey % 90, '  ', lower(c_mktsegment), ' Rd n', c_nationkey, ' ')"), "c": F.expr("concat(' City of Nation_', c_nationkey, ' City Council')")})
    return x.select("c_custkey", text.normalize_address("a").alias("address"), text.council_name("c").alias("council"))


# -- versions -------------------------------------------------------------------------------------------------------


@query("source_id:l, version_id:l, extracted_at:t, integration_status:s", """
    SELECT source_id, version_id, extracted_at, integration_status FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY extracted_at DESC, version_id DESC) r FROM version) WHERE r = 1""", "version")
def latest_version(t):
    return versions.latest_version(t("version"))


@query("version_id:l, n:l, revenue:d", """
    WITH v AS (SELECT version_id, row_number() OVER (PARTITION BY source_id ORDER BY extracted_at DESC, version_id DESC) r FROM version WHERE integration_status = 'integrated')
    SELECT l_orderkey version_id, count(*) n, sum(l_extendedprice) revenue FROM lineitem JOIN v ON l_orderkey = version_id AND r = 1 GROUP BY ALL""", "version")  # fmt: skip
def latest_facts(t):
    facts = t("lineitem").select(F.col("l_orderkey").alias("version_id"), "l_extendedprice")
    latest = versions.latest_facts(facts, t("version").where("integration_status = 'integrated'"))
    return latest.groupBy("version_id").agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("revenue"))


@query("cost_id:l, option_code:s, valid_to:t", "SELECT cost_id, option_code, valid_to FROM cost WHERE valid_from <= DATE '2024-01-15' AND (valid_to IS NULL OR valid_to >= DATE '2024-06-01' OR valid_to >= DATE '2024-01-15')", "cost")
def effective_costs(t):
    return versions.current(t("cost"), "2024-01-15")


@query("partial:l, complete:l", """
    WITH f AS (SELECT DISTINCT l_suppkey version_id, l_partkey % (l_suppkey % 3 + 1) + l_suppkey % 2 k, 1 v FROM lineitem),
    s AS (SELECT s_suppkey version_id, s_suppkey % 20 source_id, s_suppkey % 5 a, 5 + s_suppkey % 7 b FROM supplier),
    p AS (SELECT x.version_id AS "partial", y.version_id complete, y.b "to" FROM s x JOIN s y ON x.source_id = y.source_id AND x.version_id <> y.version_id AND y.a <= x.a AND y.b >= x.b AND (y.a < x.a OR y.b > x.b)
          WHERE EXISTS (SELECT 1 FROM f WHERE version_id = x.version_id) AND NOT EXISTS (SELECT 1 FROM f WHERE version_id = x.version_id AND NOT EXISTS (SELECT 1 FROM f g WHERE g.version_id = y.version_id AND g.k = f.k)))
    SELECT "partial", max_by(complete, "to" * 100000 + complete) complete FROM p GROUP BY "partial" """)  # fmt: skip
def superseded_versions(t):
    f = t("lineitem").selectExpr("l_suppkey AS version_id", "l_partkey % (l_suppkey % 3 + 1) + l_suppkey % 2 AS k", "1 AS v").distinct()
    s = t("supplier").selectExpr("s_suppkey AS version_id", "s_suppkey % 20 AS source_id", "s_suppkey % 5 AS observed_from", "5 + s_suppkey % 7 AS observed_to", "0 AS extracted_at")
    return versions.superseded(s, f, ["v"], ["k"])


@query("k:l, a:s, b:s", """
    SELECT c_custkey k, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE nullif(c_mktsegment, 'MACHINERY') END a, 'new' b FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY'), 'old' FROM customer WHERE c_custkey % 4 <> 0""")
def upsert(t):
    c = t("customer")
    return versions.upsert(c.selectExpr("c_custkey AS k", "nullif(c_mktsegment, 'MACHINERY') AS a", "'old' AS b"), c.where("c_custkey % 4 = 0").selectExpr("c_custkey AS k", "c_mktsegment AS a", "'new' AS b"), ["k"])


@query("k:l, a:s, b:l", """
    WITH o AS (SELECT c_custkey k, nullif(c_mktsegment, 'MACHINERY') a, nullif(c_nationkey, 2) b FROM customer WHERE c_custkey % 3 > 0),
    n AS (SELECT o_custkey k, arg_min(o_orderstatus, o_orderkey) a, arg_min(o_orderkey, o_orderkey) b FROM orders GROUP BY 1)
    SELECT coalesce(o.k, n.k) k, coalesce(o.a, n.a) a, coalesce(o.b, n.b) b FROM o FULL JOIN n ON o.k = n.k""")
def fill_missing(t):
    old = t("customer").where("c_custkey % 3 > 0").selectExpr("c_custkey AS k", "nullif(c_mktsegment, 'MACHINERY') AS a", "CAST(nullif(c_nationkey, 2) AS BIGINT) AS b")
    return versions.fill_missing(old, t("orders").selectExpr("o_custkey AS k", "o_orderstatus AS a", "o_orderkey AS b", "o_orderkey AS n"), ["k"], "n")


# -- spatial joins --------------------------------------------------------------------------------------------------

_IN = "x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax"


@query("lga_id:l, n:l", f"SELECT lga_id, count(*) n FROM urban_tree JOIN lga ON {_IN} GROUP BY ALL", "urban_tree lga")
def points_in_areas(t):
    return spatial_join.points_in_areas(t("urban_tree"), t("lga")).groupBy("lga_id").agg(F.count("*").alias("n"))


@query("bucket:l, n:l", f"SELECT floor(x / 10000) bucket, count(*) n FROM urban_tree WHERE EXISTS (SELECT 1 FROM lga WHERE lga_id < 7 AND {_IN}) GROUP BY 1", "urban_tree lga")
def clip_points(t):
    x = spatial_join.points_in_areas(t("urban_tree"), t("lga").where("lga_id < 7"), "left_semi")
    return x.groupBy(F.floor(F.col("x") / 10000).alias("bucket")).agg(F.count("*").alias("n"))


@query("parcel_id:l", "SELECT parcel_id FROM parcel p WHERE EXISTS (SELECT 1 FROM lga b WHERE lga_id % 3 = 0 AND p.xmin <= b.xmax AND p.xmax >= b.xmin AND p.ymin <= b.ymax AND p.ymax >= b.ymin)", "parcel lga")
def clip_parcels(t):
    return spatial_join.areas_meet(t("parcel").select("parcel_id", "xmin", "ymin", "xmax", "ymax"), t("lga").where("lga_id % 3 = 0").select("lga_id", "xmin", "ymin", "xmax", "ymax"))


@query("parcel_id:l, n_trees:l", f"SELECT p.parcel_id, count(t.x) n_trees FROM parcel p LEFT JOIN urban_tree t ON t.x BETWEEN xmin AND xmax AND t.y BETWEEN ymin AND ymax GROUP BY ALL", "parcel urban_tree")
def trees_per_parcel(t):
    return spatial_join.count_in_areas(t("parcel"), t("urban_tree"), "parcel_id", "n_trees")


@query("parcel_id:l, lga_name:s", f"SELECT parcel_id, arg_min(lga_name, a) lga_name FROM (SELECT parcel_id, lga_name, l.area_m2 a FROM parcel p JOIN lga l ON p.x BETWEEN l.xmin AND l.xmax AND p.y BETWEEN l.ymin AND l.ymax) GROUP BY ALL", "parcel lga")
def lga_lookup(t):
    return spatial_join.smallest_area(t("parcel").select("parcel_id", "x", "y"), t("lga"), "parcel_id", "lga_name", size=12000.0)


@query("centre_id:l, layer:s, id:s, distance_m:d, rank:l", """
    WITH c AS (SELECT parcel_id centre_id, x cx, y cy FROM parcel),
    p AS (SELECT centre_id, 'trees' layer, CAST(l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey AS VARCHAR) id, sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y)) distance_m
          FROM c JOIN (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, x, y FROM tree) ON abs(cx - x) <= 1500 AND abs(cy - y) <= 1500
          UNION ALL SELECT centre_id, 'parcels', CAST(parcel_id AS VARCHAR), sqrt(greatest(xmin - cx, 0, cx - xmax) ** 2 + greatest(ymin - cy, 0, cy - ymax) ** 2) FROM c JOIN parcel ON xmin - cx <= 1500 AND cx - xmax <= 1500)
    SELECT *, row_number() OVER (PARTITION BY centre_id, layer ORDER BY distance_m, id) AS rank FROM p WHERE distance_m <= 1500 QUALIFY rank <= 5""", "parcel tree")  # fmt: skip
def radius_topk(t):
    trees = t("tree").selectExpr("l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey AS id", "x", "y").distinct()
    parcels = t("parcel").selectExpr("parcel_id AS id", "xmin", "ymin", "xmax", "ymax")
    centres = t("parcel").selectExpr("parcel_id AS centre_id", "x AS cx", "y AS cy")
    return property.environment_context(centres, {"trees": trees, "parcels": parcels}, 1500.0, 5)


@query("parcel_id:l, heat_value:d", """
    SELECT parcel_id, h.heat_value FROM parcel LEFT JOIN (SELECT cell_id, arg_max(heat_value, (observed_on, source_scene_id, heat_value)) heat_value FROM heat GROUP BY ALL) h ON h.cell_id = floor(x / 3000) * 20 + floor(y / 3000)""", "parcel heat")
def cell_lookup(t):
    cells = t("heat").selectExpr("CAST(floor(cell_id / 20) AS BIGINT) AS cell_x", "cell_id % 20 AS cell_y", "observed_on", "heat_value", "struct(source_scene_id, heat_value) AS cell_id")
    return property.cell_lookup(t("parcel"), cells, "heat_value", 3000.0, "heat_value")


@query("p:l, a:l", f"""
    WITH h AS (SELECT id, min(parcel_id) a FROM (SELECT l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey id, x px, y py FROM tree) JOIN parcel ON px BETWEEN xmin AND xmax AND py BETWEEN ymin AND ymax GROUP BY id)
    SELECT min(id) p, a FROM h GROUP BY a HAVING count(*) = 1""", "tree parcel")
def lone_trees(t):
    trees = t("tree").selectExpr("l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey AS p", "x", "y")
    return spatial_join.polygons_hit_once(trees, t("parcel").selectExpr("parcel_id AS a", "xmin", "ymin", "xmax", "ymax"), "p", "a")


# -- weather --------------------------------------------------------------------------------------------------------

_RECENT = f"SELECT * FROM weather WHERE observed_at >= TIMESTAMP '{AS_OF}' - INTERVAL 3 HOUR AND observed_at <= TIMESTAMP '{AS_OF}' + INTERVAL 5 MINUTE"


def _as_of():
    return F.expr(f"TIMESTAMP_NTZ '{AS_OF}'")


@query("station_code:l, observation_id:l, air_temperature_c:d", f"SELECT station_code, observation_id, air_temperature_c FROM ({_RECENT}) QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY observed_at DESC, observation_id DESC) = 1", "weather")
def weather_latest(t):
    return weather.latest_by_station(t("weather"), _as_of())


@query("parcel_id:l, station_code:l, distance_km:d, age_minutes:d, context_status:s, air_temperature_c:d", f"""
    WITH s AS (SELECT * FROM ({_RECENT}) QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY observed_at DESC, observation_id DESC) = 1),
    n AS (SELECT p.parcel_id, s.*, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) d FROM parcel p, s QUALIFY row_number() OVER (PARTITION BY p.parcel_id ORDER BY d, station_code) = 1)
    SELECT parcel_id, station_code, round(d / 1000, 2) distance_km, round(greatest(epoch(date_trunc('second', TIMESTAMP '{AS_OF}')) - epoch(date_trunc('second', observed_at)), 0) / 60, 1) age_minutes,
           CASE WHEN d <= 10000 THEN 'good_local_context' WHEN d <= 25000 THEN 'regional_context_warning' ELSE 'too_distant_temperature_suppressed' END context_status,
           CASE WHEN d <= 25000 THEN air_temperature_c END air_temperature_c FROM n""", "parcel weather")  # fmt: skip
def nearest_station(t):
    return weather.nearest_recent(t("parcel"), t("weather"), _as_of())


# -- address and property -------------------------------------------------------------------------------------------

_REQUESTS = "SELECT c_custkey request_id, concat(CAST(c_custkey % 200 AS VARCHAR), ' ', substr(c_mktsegment, 1, 4)) request FROM customer"


def _requests(t):
    return t("customer").selectExpr("c_custkey AS request_id", "concat(c_custkey % 200, ' ', lower(substr(c_mktsegment, 1, 4))) AS request")


@query("request_id:l, address_id:l, rank:l", f"""
    WITH q AS ({_REQUESTS}) SELECT request_id, address_id, row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN full_address = request THEN 0 ELSE 1 END, CASE WHEN is_primary = 'Y' THEN 0 ELSE 1 END, full_address, address_id) AS rank
    FROM q JOIN address ON starts_with(upper(full_address), request) QUALIFY rank <= 10""", "address")  # fmt: skip
def address_prefix(t):
    return property.autocomplete(_requests(t), t("address"))


@query("address:s, address_id:l, parcel_id:l, ids:s, n_addresses:l", """
    SELECT upper(full_address) address, min(address_id) address_id, arg_min(parcel_id, address_id) parcel_id, array_to_string(list_sort(list(DISTINCT address_id)), ',') ids, count(DISTINCT address_id) n_addresses
    FROM address GROUP BY 1""", "address")
def address_groups(t):
    return property.grouped_addresses(t("address")).withColumn("ids", F.array_join(F.col("address_ids").cast("array<string>"), ","))


@query("request_id:l, status:s, n_matches:l, address_id:l", f"""
    WITH q AS ({_REQUESTS}), m AS (SELECT request_id, count(*) n, count_if(full_address = request) e, min((full_address = request, full_address, address_id)) b FROM q JOIN address ON starts_with(upper(full_address), request) GROUP BY ALL)
    SELECT q.request_id, CASE WHEN n IS NULL THEN 'no_match' WHEN e = 0 AND n > 1 THEN 'ambiguous' ELSE 'resolved' END status, coalesce(n, 0) n_matches,
           CASE WHEN n = 1 OR e > 0 THEN (SELECT address_id FROM address a WHERE starts_with(upper(a.full_address), request) ORDER BY full_address <> request, full_address, address_id LIMIT 1) END address_id
    FROM q LEFT JOIN m USING (request_id)""", "address")  # fmt: skip
def address_resolve(t):
    return property.resolve(_requests(t), t("address"))


_HEAT_CELL = "SELECT cell_id, arg_max(heat_value, (observed_on, source_scene_id, heat_value)) v FROM heat GROUP BY ALL"


@query("parcel_id:l, heat_value:d, canopy_pct:d, n_trees:l, lot_size:s, heat_class:s, canopy_class:s, station_code:l, limitations:s", f"""
    WITH h AS ({_HEAT_CELL}), t AS (SELECT p.parcel_id, count(t.x) n FROM parcel p LEFT JOIN urban_tree t ON t.x BETWEEN xmin AND xmax AND t.y BETWEEN ymin AND ymax GROUP BY ALL),
    s AS (SELECT * FROM ({_RECENT}) QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY observed_at DESC, observation_id DESC) = 1),
    w AS (SELECT p.parcel_id, s.station_code, sqrt((p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y)) d FROM parcel p, s QUALIFY row_number() OVER (PARTITION BY p.parcel_id ORDER BY d, s.station_code) = 1)
    SELECT p.parcel_id, a.v heat_value, b.v * 2 canopy_pct, n n_trees, CASE WHEN area_m2 <= 0 THEN 'unknown' WHEN area_m2 < 400 THEN 'small' WHEN area_m2 <= 800 THEN 'medium' ELSE 'large' END lot_size,
           {_band('a.v')} heat_class, CASE WHEN b.v IS NULL OR b.v * 2 > 100 THEN 'Unavailable' ELSE {_canopy('b.v * 2')} END canopy_class, w.station_code,
           CASE WHEN a.v IS NULL AND b.v IS NULL THEN '{{"canopy":"no canopy cell covers the property; this is not zero canopy","heat":"no heat cell covers the property"}}'
                WHEN a.v IS NULL THEN '{{"heat":"no heat cell covers the property"}}' WHEN b.v IS NULL THEN '{{"canopy":"no canopy cell covers the property; this is not zero canopy"}}' ELSE '{{}}' END limitations
    FROM parcel p LEFT JOIN h a ON a.cell_id = floor(p.x / 500) * 120 + floor(p.y / 500) LEFT JOIN h b ON b.cell_id = floor(p.x / 500) * 5 + floor(p.y / 500) JOIN t USING (parcel_id) JOIN w USING (parcel_id)""", "parcel heat urban_tree weather")  # fmt: skip
def property_baseline(t):
    latest = t("heat").groupBy("cell_id").agg(F.max(F.struct("observed_on", "source_scene_id", "heat_value")).alias("h"))  # before cells are multiplied

    def cells(rows, factor):
        x = latest.selectExpr(f"floor(cell_id / {rows}) AS q", "cell_id", "h.observed_on AS observed_on", f"h.heat_value * {factor} AS v", "struct(h.source_scene_id, h.heat_value) AS k")
        # A cell number stands for each pair of column and row that it can come from.
        x = x.withColumn("cell_x", F.explode(F.sequence(F.lit(0), F.least(F.col("q"), F.lit(119))))).withColumn("cell_y", F.col("cell_id") - F.col("cell_x") * rows)
        return x.where("cell_y between 0 and 119").select("cell_x", "cell_y", "observed_on", F.col("v"), F.col("k").alias("cell_id"))

    near = weather.nearest_recent(t("parcel"), t("weather"), _as_of())
    heat, canopy = cells(120, 1).withColumnRenamed("v", "heat_value"), cells(5, 2).withColumnRenamed("v", "canopy_pct")
    return property.baseline(t("parcel"), heat, canopy, t("urban_tree"), near)


@query("parcel_id:l, category_code:s, category_status:s", """
    WITH a AS (SELECT o_custkey parcel_id, 'cat' || o_orderkey % 7 category_code, o_totalprice confidence, o_orderdate updated_at, o_orderkey id FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 <> 3 AND o_orderdate <= TIMESTAMP '1999-01-01'),
    b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY parcel_id ORDER BY confidence DESC, updated_at DESC, id) = 1)
    SELECT parcel_id, coalesce(category_code, 'unclassified') category_code, CASE WHEN category_code IS NULL THEN 'unclassified_source_not_loaded' ELSE 'source_backed_category' END category_status FROM parcel LEFT JOIN b USING (parcel_id)""", "parcel")  # fmt: skip
def property_category(t):
    a = t("orders").selectExpr("o_custkey AS parcel_id", "concat('cat', o_orderkey % 7) AS category_code", "o_totalprice AS confidence", "o_orderdate AS updated_at", "o_orderkey AS assignment_id", "o_orderstatus = 'F' AS active", "true AS is_primary", "CAST(o_orderdate AS DATE) AS valid_from", "CAST(NULL AS DATE) AS valid_to")
    c = t("orders").selectExpr("concat('cat', o_orderkey % 7) AS category_code", "o_orderkey % 7 <> 3 AS active").distinct()
    return property.property_category(t("parcel"), a, c, F.lit("1999-01-01").cast("date"))


# -- species and costs ----------------------------------------------------------------------------------------------


@query("lga_code:l, popularity_rank:l, species_key:s, n_trees:l, share_pct:d, median_height_m:d, status:s", """
    WITH o AS (SELECT lga_id lga_code, 'scientific:' || lower(scientific_name) species_key, common_name, scientific_name, height_m FROM tree JOIN lga ON lga_id = l_partkey % 30 WHERE municipality_id = lga_id AND lga_id % 6 <> 1),
    c AS (SELECT lga_code, species_key, min(scientific_name) scientific_name, min(common_name) common_name, count(*) n_trees, round(quantile_cont(height_m, 0.5), 2) median_height_m FROM o GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY lga_code ORDER BY n_trees DESC, common_name, species_key) popularity_rank, round(100.0 * n_trees / sum(n_trees) OVER (PARTITION BY lga_code), 2) share_pct FROM c),
    e AS (SELECT 'scientific:' || lower(scientific_name) species_key, min(common_name) common_name, count(*) n_trees, round(quantile_cont(height_m, 0.5), 2) median_height_m FROM tree GROUP BY 1),
    f AS (SELECT *, row_number() OVER (ORDER BY n_trees DESC, common_name, species_key) popularity_rank, round(100.0 * n_trees / sum(n_trees) OVER (), 2) share_pct FROM e)
    SELECT lga_code, popularity_rank, species_key, n_trees, share_pct, median_height_m, 'observed_public_tree_frequency' status FROM r WHERE popularity_rank <= 10
    UNION ALL SELECT lga_id, popularity_rank, species_key, n_trees, share_pct, median_height_m, 'fallback_overall_observed_public_tree_frequency' FROM lga, f WHERE popularity_rank <= 10 AND lga_id NOT IN (SELECT lga_code FROM r)""", "tree lga")  # fmt: skip
def popularity(t):
    lga = t("lga").selectExpr("lga_id AS lga_code", "lga_name")
    trees = t("tree").selectExpr("*", "l_partkey % 30 AS lga_code", "CASE WHEN municipality_id % 6 <> 1 THEN concat('City of nation_', municipality_id) END AS municipality")
    return species.popularity(trees, lga)


@query("lga_code:l, species_key:s, list_category:s", """
    WITH g AS (SELECT DISTINCT p_size % 25 lga_code, 'scientific:' || lower(p_name) species_key, CASE p_partkey % 6 WHEN 0 THEN 'not_recommended' WHEN 1 THEN 'conditional' WHEN 2 THEN 'approval_required' WHEN 3 THEN 'approved' ELSE 'recommended' END s FROM part)
    SELECT lga_code, species_key, CASE WHEN bool_or(s = 'not_recommended') THEN 'not_recommended' WHEN bool_or(s IN ('conditional', 'approval_required')) THEN 'council_approval_required' ELSE 'available_now' END list_category
    FROM g WHERE (lga_code, species_key) IN (SELECT l_partkey % 30, 'scientific:' || lower(scientific_name) FROM tree) GROUP BY ALL""", "tree")  # fmt: skip
def guidance_category(t):
    g = t("part").selectExpr("p_size % 25 AS lga_code", "p_name AS scientific_name", "p_brand AS common_name", "CASE p_partkey % 6 WHEN 0 THEN 'not_recommended' WHEN 1 THEN 'conditional' WHEN 2 THEN 'approval_required' WHEN 3 THEN 'approved' ELSE 'recommended' END AS guidance_status")
    s = t("tree").select((F.col("l_partkey") % 30).alias("lga_code"), species.species_key().alias("species_key"))
    return species.guidance_category(s, g)


@query("species_key:s, priced_tree_type:s, supply_min:d, supply_max:d, installed_min:d, installed_max:d, cost_sources:s, sized:b", """
    SELECT lower(botanical_name) species_key, min(tree_type) priced_tree_type, min(minimum_cost) FILTER (WHERE option_code = 'backyard_tree_diy') supply_min, max(maximum_cost) FILTER (WHERE option_code = 'backyard_tree_diy') supply_max,
           min(minimum_cost) FILTER (WHERE option_code = 'backyard_tree_installed') installed_min, max(maximum_cost) FILTER (WHERE option_code = 'backyard_tree_installed') installed_max,
           string_agg(DISTINCT source_name, ',' ORDER BY source_name) cost_sources, bool_or(size_price_status = 'exact_listed_size_price') sized FROM cost WHERE option_code LIKE 'backyard%' GROUP BY 1""", "cost")  # fmt: skip
def exact_costs(t):
    return species.exact_costs(t("cost"))


@query("species_key:s, tree_type:s, supply_min:d, cost_status:s, size_price_status:s", """
    WITH c AS (SELECT lower(botanical_name) species_key, min(tree_type) tt, min(minimum_cost) FILTER (WHERE option_code = 'backyard_tree_diy') supply_min, bool_or(size_price_status = 'exact_listed_size_price') sized FROM cost WHERE option_code LIKE 'backyard%' GROUP BY 1),
    s AS (SELECT lower(n) species_key, min(n) n, min(b) b FROM (SELECT CASE WHEN l_partkey % 5 = 0 THEN split_part(scientific_name, ' ', 1) || ' sp.' ELSE scientific_name || ' minor' END n, common_name b FROM tree UNION ALL SELECT botanical_name, tree_type FROM cost WHERE option_code LIKE 'backyard%') GROUP BY 1)
    SELECT s.species_key, coalesce(tt, b, n) tree_type, supply_min, CASE WHEN sized IS NOT NULL THEN 'species_specific_current_source_range' WHEN n LIKE '% sp.' THEN 'unavailable_unresolved_tree_identity' ELSE 'unavailable_no_species_quote' END cost_status,
           CASE WHEN sized THEN 'species_size_price_available' WHEN sized IS NOT NULL THEN 'species_price_size_unmapped' WHEN n LIKE '% sp.' THEN 'unavailable_unresolved_tree_identity' ELSE 'unavailable_no_species_quote' END size_price_status
    FROM s LEFT JOIN c USING (species_key)""", "tree cost")  # fmt: skip
def species_catalogue(t):
    p = t("tree").selectExpr("CASE WHEN l_partkey % 5 = 0 THEN concat(split_part(scientific_name, ' ', 1), ' sp.') ELSE concat(scientific_name, ' minor') END AS scientific_name", "common_name")
    return species.catalogue(p, t("cost"))


@query("species_key:s, scientific_name:s, n_trees:l, common_name:s", """
    WITH n AS (SELECT lower(scientific_name) species_key, common_name, count(*) n FROM tree GROUP BY ALL), s AS (SELECT lower(scientific_name) species_key, min(scientific_name) scientific_name, count(*) n_trees FROM tree GROUP BY 1),
    b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY species_key ORDER BY n DESC, common_name) = 1)
    SELECT species_key, scientific_name, n_trees, common_name FROM s JOIN b USING (species_key) ORDER BY n_trees DESC, species_key LIMIT 10""", "tree")  # fmt: skip
def top_species(t):
    return species.top_species(t("tree"))


@query("species_key:s, image_url:s", """
    SELECT p_name species_key, 'https://img/' || p_partkey || '.jpg' image_url FROM part WHERE p_type <> 'ECONOMY' QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_size % 2 DESC, p_retailprice DESC, 'https://img/' || p_partkey || '.jpg' DESC) = 1""")
def image_choice(t):
    i = t("part").selectExpr("p_name AS species_key", "concat('https://img/', p_partkey, '.jpg') AS image_url", "p_type AS licence", "'u' AS licence_url", "p_size % 2 = 1 AS curated", "p_retailprice AS updated_at")
    return species.choose_image(i, i.where("licence <> 'ECONOMY'").select("licence", "licence_url").distinct())


# -- pixels ---------------------------------------------------------------------------------------------------------


@query("xmin:l, ymin:l, value:d, n_pixels:l", """
    WITH d AS (SELECT x, y, dn * 0.00341802 + (149.0 - 273.15) c FROM pixel WHERE dn > 0 AND (qa & 191) = 0)
    SELECT floor(x / 5000) * 5000 xmin, floor(y / 5000) * 5000 ymin, round(avg(c), 3) AS value, count(*) n_pixels FROM d WHERE c BETWEEN -50 AND 80 GROUP BY 1, 2""", "pixel")
def lst_cells(t):
    return raster.cell_mean(raster.decode_lst(t("pixel")), "lst_c", 5000.0)


@query("xmin:l, ymin:l, canopy_pct:d", "SELECT floor(x / 5000) * 5000 xmin, floor(y / 5000) * 5000 ymin, round(avg(value) * 100, 2) canopy_pct FROM pixel WHERE value <> 255 GROUP BY 1, 2", "pixel")
def canopy_cells(t):
    return raster.canopy_percent(t("pixel"), size=5000.0)


@query("xmin:l, ymin:l, canopy_pct:d, confidence:d", """
    SELECT floor(x / 5000) * 5000 xmin, floor(y / 5000) * 5000 ymin, round(count_if(value = 1) / count_if(value <> 255) * 100, 2) canopy_pct, round(least(1, count_if(value <> 255) / 400) * 100, 2) confidence
    FROM pixel GROUP BY 1, 2 HAVING count_if(value <> 255) > 0""", "pixel")
def canopy_tiles(t):
    return raster.canopy_from_tiles(t("pixel"), size=5000.0, pixel_area=62500.0, tiles=8)


@query("cell_key:s, observed_year:l, cultivated_vegetation_pct:d, artificial_surface_pct:d, water_pct:d, valid_data_pct:d, dominant_level3_code:l", """
    WITH n AS (SELECT floor(x / 5000) * 5000 gx, floor(y / 5000) * 5000 gy, count(*) a, count_if(class <> 255) v, count_if(class = 111) c1, count_if(class = 112) c2, count_if(class = 124) c3, count_if(class = 215) c4, count_if(class = 216) c5, count_if(class = 220) c6 FROM pixel GROUP BY 1, 2)
    SELECT 'epsg7855:' || CAST(gx AS BIGINT) || ':' || CAST(gy AS BIGINT) || ':5000' cell_key, 2024 observed_year, round(c1 / v * 100, 4) cultivated_vegetation_pct, round(c4 / v * 100, 4) artificial_surface_pct, round(c6 / v * 100, 4) water_pct, round(v / a * 100, 4) valid_data_pct,
           CASE greatest(c1, c2, c3, c4, c5, c6) WHEN c1 THEN 111 WHEN c2 THEN 112 WHEN c3 THEN 124 WHEN c4 THEN 215 WHEN c5 THEN 216 ELSE 220 END dominant_level3_code FROM n WHERE v > 0""", "pixel")  # fmt: skip
def landcover_fractions(t):
    return raster.land_cover_fractions(t("pixel").selectExpr("x", "y", "class AS value", "2024 AS observed_year"), 5000.0)


@query("parcel_id:l, coverage_pct:d, canopy_m2:d, canopy_pct:d, status:s", """
    WITH n AS (SELECT p.parcel_id, any_value(area_m2) a, any_value((xmax - xmin) * (ymax - ymin)) b, count(q.value) n, count_if(q.value = 1) t FROM parcel p LEFT JOIN (SELECT * FROM pixel WHERE value <> 255) q ON q.x BETWEEN xmin AND xmax AND q.y BETWEEN ymin AND ymax GROUP BY ALL)
    SELECT parcel_id, round(least(100, n * 400.0 / a * 100), 2) coverage_pct, CASE WHEN n * 400.0 / a * 100 >= 95 THEN round(t * 400.0, 2) END canopy_m2, CASE WHEN n * 400.0 / a * 100 >= 95 THEN round(t / n * 100, 2) END canopy_pct,
           CASE WHEN n * 400.0 / a * 100 >= 95 THEN 'passed' ELSE 'failed' END status FROM n""", "parcel pixel")  # fmt: skip
def parcel_zonal(t):
    return raster.parcel_canopy(t("parcel"), t("pixel"), 400.0)


@query("tile_id:l, xmin:l, ymin:l, xmax:l, ymax:l, n_pixels:l, sample_values:s", "SELECT tile_id, min(x) xmin, min(y) ymin, max(x) xmax, max(y) ymax, count(*) n_pixels, array_to_string(list_sort(list(DISTINCT value)), ',') sample_values FROM pixel GROUP BY ALL", "pixel")
def raster_profile(t):
    return raster.raster_profile(t("pixel")).withColumn("sample_values", F.array_join(F.col("sample_values").cast("array<string>"), ","))


@query("scene_id:l, path:l, row:l, acquired_on:t", """
    WITH s AS (SELECT o_orderkey scene_id, o_custkey % 9 AS path, o_custkey % 5 AS "row", CAST(o_orderdate AS DATE) acquired_on, o_totalprice cloud, o_orderstatus tier FROM orders),
    b AS (SELECT * FROM s WHERE tier = 'F' QUALIFY row_number() OVER (PARTITION BY path, "row" ORDER BY acquired_on DESC, cloud, scene_id) = 1)
    SELECT scene_id, path, "row", acquired_on FROM b ORDER BY acquired_on DESC, cloud, scene_id LIMIT 10""")  # fmt: skip
def scene_choice(t):
    s = t("orders").selectExpr("o_orderkey AS scene_id", "o_custkey % 9 AS path", "o_custkey % 5 AS row", "CAST(o_orderdate AS DATE) AS acquired_on", "o_totalprice AS cloud_cover", "CASE o_orderstatus WHEN 'F' THEN 'T1' ELSE 'T2' END AS tier")
    return raster.choose_scenes(s)


# -- scenarios ------------------------------------------------------------------------------------------------------


@query("parcel_id:l, action:s, valid:b, area_min_m2:d, area_max_m2:d, cooling_min_c:d, cooling_max_c:d, status:s", """
    WITH a(action, lo, hi, target, bound) AS (VALUES ('tree', 6.6 * 0.25, 43.7, NULL, 6.0), ('potted_plants', 4 * 0.15 * 0.49, 1.2, 1.0, NULL), ('garden_bed', 16 * 0.49 * 0.8, 20.0, NULL, 6.0), ('green_wall', 8 * 0.49 * 0.8, 10.0, 10.0, 15.5))
    SELECT parcel_id, action, true AS valid, round(lo::DOUBLE, 3) area_min_m2, round(hi::DOUBLE, 3) area_max_m2, CASE WHEN bound IS NOT NULL THEN 0.0 END cooling_min_c, round(bound::DOUBLE * least(hi::DOUBLE / coalesce(target, area_m2), 1.0), 3) cooling_max_c, 'PASS' status
    FROM parcel, a""", "parcel")  # fmt: skip
def scenario_scores(t):
    return scenarios.score_parcels(t("parcel"))


@query("returnflag:s, quantity:d, area_m2:d, minimum_cost:d, maximum_cost:d, n_invalid:l", """
    SELECT l_returnflag returnflag, sum(l_quantity) quantity, sum(l_tax) area_m2, sum(l_extendedprice) minimum_cost, sum(l_extendedprice * (1 + l_tax) - 500) maximum_cost, count_if(l_extendedprice * (1 + l_tax) - 500 < l_extendedprice) n_invalid FROM lineitem GROUP BY 1""")
def community_totals(t):
    x = t("lineitem").selectExpr("l_returnflag AS returnflag", "l_quantity AS quantity", "l_tax AS area_m2", "l_extendedprice AS minimum_cost", "l_extendedprice * (1 + l_tax) - 500 AS maximum_cost")
    return scenarios.community_totals(x, "returnflag")


@query("id:l, canopy_gain_m2:d, shade_m2:d, cost_per_m2:d, error:s", """
    WITH x AS (SELECT l_orderkey * 1000 + l_linenumber id, l_quantity b, l_quantity * (1 + l_tax) - l_linenumber p, l_discount * 15 s FROM lineitem)
    SELECT id, CASE WHEN p >= 0 AND s <= 1 THEN p - b END canopy_gain_m2, CASE WHEN p >= 0 AND s <= 1 THEN p * s END shade_m2, CASE WHEN p >= 0 AND s <= 1 AND p > b THEN 1200 / (p - b) END cost_per_m2,
           concat_ws('; ', CASE WHEN p < 0 THEN 'negative_canopy' END, CASE WHEN s > 1 THEN 'factor_out_of_bounds' END) error FROM x""")  # fmt: skip
def measures(t):
    x = t("lineitem").selectExpr(
        "l_orderkey * 1000 + l_linenumber AS id", "l_quantity AS baseline_canopy_m2", "l_quantity * (1 + l_tax) - l_linenumber AS projected_canopy_m2", "l_discount * 15 AS survival", "1D AS suitability", "1D AS overlap",
        "10D AS baseline_greenery_pct", "20D AS projected_greenery_pct", "1200D AS total_cost", "40D AS baseline_lst_c", "38D AS projected_lst_c",
    )
    return scenarios.measures(x)


@query("option_code:s, action:s, n:l, low:d, high:d", """
    WITH s(action, q, lo, hi) AS (VALUES ('tree', 1, 1.0, 1.0), ('potted_plants', 4, 1.0, 1.0), ('garden_bed', 1, 16.0, 20.0), ('green_wall', 1, 8.0, 10.0)),
    o(action, option_code) AS (VALUES ('tree', 'backyard_tree_diy'), ('tree', 'backyard_tree_installed'), ('potted_plants', 'potted_plants'), ('garden_bed', 'garden_bed'), ('green_wall', 'green_wall'))
    SELECT option_code, action, count(*) n, min(round((q * lo)::DOUBLE * minimum_cost, 2)) low, max(round((q * hi)::DOUBLE * maximum_cost, 2)) high FROM s JOIN o USING (action) JOIN cost USING (option_code) GROUP BY ALL""", "cost")  # fmt: skip
def action_cost(t):
    s = t("cost").sparkSession.createDataFrame(list(scenarios.EXAMPLES), scenarios.EXAMPLE_SCHEMA)
    x = scenarios.action_costs(s, t("cost"))
    return x.groupBy("option_code", "action").agg(F.count("*").alias("n"), F.min("minimum_cost_aud").alias("low"), F.max("maximum_cost_aud").alias("high"))


@query("o_custkey:l, o_orderkey:l, price_diff:d", """
    WITH b AS (SELECT o_custkey, min(o_orderkey) k FROM orders GROUP BY 1) SELECT o.o_custkey, o.o_orderkey, o.o_totalprice - p.o_totalprice price_diff FROM orders o JOIN b USING (o_custkey) JOIN orders p ON p.o_orderkey = b.k""")
def scenario_compare(t):
    o = t("orders").selectExpr("o_custkey", "o_orderkey", "o_totalprice AS price")
    first = o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("_k"))
    x = o.join(first, "o_custkey").withColumn("preferred", F.col("o_orderkey") == F.col("_k"))
    return scenarios.compare_to_preferred(x, "o_custkey", ["price"])


# -- growth and linkage ---------------------------------------------------------------------------------------------


def _growth_rows(t):
    """Trees whose crown grows with age, by a rule over the line items."""
    return t("lineitem").selectExpr(
        "l_orderkey * 1000000 + l_partkey * 1000 + l_suppkey AS tree_id", "concat('species ', l_partkey % 20) AS species", "CAST(1940 + l_orderkey % 80 AS INT) AS year_planted", "CAST('2022-06-01' AS DATE) AS observed_on",
        "exp(0.5D + 0.5D * ln(2023 - (1940 + l_orderkey % 80)) * (1 + (l_partkey % 20) / 100D) + (l_quantity - 25) / 50D) / 3 AS canopy_width_m", "nullif(l_quantity, 7) AS height_m", "l_quantity AS dbh_cm",
    )


@query("species:s, n:l, oldest:l", """
    WITH g AS (SELECT 'species ' || l_partkey % 20 species, 1940 + l_orderkey % 80 p, exp(0.5 + 0.5 * ln(2023 - (1940 + l_orderkey % 80)) * (1 + (l_partkey % 20) / 100.0::DOUBLE) + (l_quantity - 25) / 50.0::DOUBLE) / 3 w FROM lineitem)
    SELECT species, count(*) n, max(2022 - p) oldest FROM g WHERE p >= 1950 AND w > 0 AND w <= 30 GROUP BY 1 HAVING count(*) >= 30""")
def growth_training_set(t):
    return growth.training_set(_growth_rows(t)).groupBy("species").agg(F.count("*").alias("n"), F.max("age").alias("oldest"))


@query("species:s, target:s, n:l, max_age:d, p10_b:d, p50_b:d, p90_b:d")
def growth_lines(t):
    x = growth.split(growth.training_set(_growth_rows(t)), "tree_id")
    return growth.fit_lines(x.where("is_train"), "canopy_m2")


@query("species:s, years:l, status:s, canopy_m2_p10:d, canopy_m2_p50:d, canopy_m2_p90:d")
def growth_predictions(t):
    lines = growth.fit_lines(growth.training_set(_growth_rows(t)), "canopy_m2")
    asked = t("part").selectExpr("concat('species ', p_partkey % 21) AS species", "CAST(p_size AS DOUBLE) AS years", "CASE p_partkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'L' END AS size", "CASE p_partkey % 3 WHEN 2 THEN 2D END AS start_width_m")
    return growth.predict(asked, lines)


@query("source_tree_id:l, species:s, width_m:d", """
    SELECT l_orderkey source_tree_id, arg_min(p, n) species, arg_min(w, n) width_m FROM (SELECT l_orderkey, p_name p, l_quantity w, l_linenumber::BIGINT * 1000000000 + l_partkey * 1000 + l_suppkey n FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_returnflag = 'A' AND l_quantity <> 7) GROUP BY 1""")
def mature_rows(t):
    x = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "l_orderkey AS source_tree_id", "p_name AS scientific_name", "CASE WHEN l_returnflag = 'A' THEN ' Over Mature ' ELSE 'Young' END AS age_description", "l_quantity AS canopy_width_m", "nullif(l_quantity, 7) AS height_m",
        "CAST(NULL AS DOUBLE) AS dbh_cm", "l_linenumber * 1000000000L + l_partkey * 1000 + l_suppkey AS row_number",
    )
    return growth.mature_rows(x)


@query("name:s, title:s, similarity:d", """
    WITH n AS (SELECT DISTINCT lower(p_name) AS name, substr(lower(p_name), 1, instr(p_name, ' ') + 2) b FROM part), t AS (SELECT DISTINCT lower(p_name) || CASE p_partkey % 3 WHEN 0 THEN 's' WHEN 1 THEN 'ium' ELSE '' END title FROM part),
    x AS (SELECT name, title, 1 - levenshtein(name, title) / greatest(length(name), length(title)) similarity FROM n JOIN t ON starts_with(title, b) AND name <> title),
    r AS (SELECT *, row_number() OVER w k, lead(similarity) OVER w nx FROM x WHERE similarity >= 0.85 WINDOW w AS (PARTITION BY name ORDER BY similarity DESC, title))
    SELECT name, title, similarity FROM r WHERE k = 1 AND (nx IS NULL OR similarity - nx >= 0.003)""")  # fmt: skip
def taxon_matches(t):
    names = t("part").selectExpr("p_name AS name")
    titles = t("part").selectExpr("concat(lower(p_name), CASE p_partkey % 3 WHEN 0 THEN 's' WHEN 1 THEN 'ium' ELSE '' END) AS title")
    return linkage.fuzzy_matches(names, titles, 0.85)


@query("source:l, final:l", """
    WITH RECURSIVE l AS (SELECT c_custkey source, c_custkey // 3 target FROM customer WHERE c_custkey > 0), w(source, final, n) AS (SELECT source, target, 1 FROM l UNION ALL SELECT w.source, l.target, n + 1 FROM w JOIN l ON l.source = w.final WHERE n < 5)
    SELECT source, arg_max(final, n) final FROM w GROUP BY 1""")
def redirects(t):
    return linkage.resolve_redirects(t("customer").where("c_custkey > 0").selectExpr("c_custkey AS source", "c_custkey DIV 3 AS target"))


# -- sources --------------------------------------------------------------------------------------------------------


@query("source_tree_id:s, scientific_name:s, display_name:s, taxonomic_precision:s, height_m:d, dbh_max_cm:d, n:l", """
    WITH r AS (SELECT l_orderkey, l_partkey, p_name, l_quantity q, l_linenumber k FROM lineitem JOIN part ON p_partkey = l_partkey),
    u AS (SELECT 'yarra:R' || l_orderkey source_tree_id, p_name scientific_name, p_name display_name, 'species' taxonomic_precision, q height_m, CAST(NULL AS DOUBLE) dbh_max_cm FROM r WHERE k % 2 = 0
          UNION ALL SELECT 'hobsons_bay:' || substr(sha256(CAST(l_partkey AS VARCHAR) || '.0|1.0|street|' || p_name), 1, 32), p_name, p_name, 'species', NULL, round(q * 10 * 0.1::DOUBLE, 4) FROM r WHERE k % 2 = 1)
    SELECT *, count(*) n FROM u GROUP BY ALL""")  # fmt: skip
def council_trees(t):
    r = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).withColumns({"g": F.expr("split_part(p_name, ' ', 1)"), "e": F.expr("split_part(p_name, ' ', 2)")})
    yarra = r.where("l_linenumber % 2 = 0").selectExpr("map('ref', concat(' R', l_orderkey), 'genus', g, 'species', concat('X. ', e), 'height', CAST(l_quantity AS STRING), 'common', 'TBD') AS properties", "CAST(l_partkey AS DOUBLE) AS longitude", "1D AS latitude")
    bay = r.where("l_linenumber % 2 = 1").selectExpr("map('Genus', g, 'Species', e, 'type', 'street', 'dbh_mm', concat('5 - ', CAST(CAST(l_quantity * 10 AS INT) AS STRING))) AS properties", "CAST(l_partkey AS DOUBLE) AS longitude", "1D AS latitude")
    x = inventories.normalise_councils({"yarra": yarra, "hobsons_bay": bay})
    keys = ["source_tree_id", "scientific_name", "display_name", "taxonomic_precision", "height_m", "dbh_max_cm"]
    return x.groupBy(*keys).agg(F.count("*").alias("n"))


@query("station_code:s, observed_at:s, wind_speed_ms:d, rainfall_since_9am_mm:d, air_temperature_c:d, n:l", """
    SELECT CAST(user_id AS VARCHAR) station_code, strftime(ts, '%Y-%m-%d %H:%M:%S') observed_at, round(value / 3.6, 3) wind_speed_ms, CASE WHEN event_id % 5 = 0 THEN 0.0 WHEN event_id % 7 <> 0 THEN value END rainfall_since_9am_mm,
           CASE WHEN event_id % 9 <> 0 THEN value END air_temperature_c, count(*) n FROM events GROUP BY ALL""")  # fmt: skip
def weather_normalise(t):
    x = t("events").selectExpr(
        "' ' AS wmo", "CAST(user_id AS STRING) AS history_product", "event_type AS name", "date_format(ts, 'yyyyMMddHHmmss') AS aifstime_utc", "CASE WHEN event_id % 9 = 0 THEN '-' ELSE CAST(value AS STRING) END AS air_temp", "'-' AS apparent_t",
        "'50' AS rel_hum", "CAST(value AS STRING) AS wind_spd_kmh", "CASE WHEN event_id % 5 = 0 THEN 'Trace' WHEN event_id % 7 = 0 THEN '-' ELSE CAST(value AS STRING) END AS rain_trace", "'-37.8' AS lat", "'144.9' AS lon",
    )
    n = inventories.normalise_weather(x).withColumn("observed_at", F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss"))
    return n.groupBy("station_code", "observed_at", "wind_speed_ms", "rainfall_since_9am_mm", "air_temperature_c").agg(F.count("*").alias("n"))


@query("requested:l, succeeded:l, coverage_pct:d, publish:b", """
    WITH f AS (SELECT user_id % 50 a, array_agg(DISTINCT CASE WHEN user_id % 50 = 3 THEN user_id ELSE user_id % 50 END) c FROM events WHERE user_id % 50 <> 9 GROUP BY 1), r AS (SELECT DISTINCT user_id % 50 s FROM events)
    SELECT count(*) requested, count_if(len(c) = 1 AND c[1] = s) succeeded, round(count_if(len(c) = 1 AND c[1] = s) / count(*) * 100, 2) coverage_pct, count_if(len(c) = 1 AND c[1] = s) / count(*) * 100 >= 80 publish FROM r LEFT JOIN f ON s = a""")  # fmt: skip
def station_coverage(t):
    e = t("events")
    feeds = e.where("user_id % 50 <> 9").selectExpr("user_id % 50 AS requested_code", "CASE WHEN user_id % 50 = 3 THEN user_id ELSE user_id % 50 END AS station_code")
    return inventories.feed_coverage(e.selectExpr("user_id % 50 AS station_code").distinct(), feeds)


@query("p_partkey:l, reasons:s", """
    SELECT p_partkey, concat_ws('; ', CASE WHEN p_size % 6 = 5 THEN 'unknown status' END, CASE WHEN p_size % 4 = 3 THEN 'unknown size' END, CASE WHEN p_size % 5 = 0 THEN 'dates out of order' END, CASE WHEN p_size % 30 > 24 THEN 'unknown council code' END) reasons FROM part""")
def guidance_rejects(t):
    rows = t("part").selectExpr(
        "p_partkey", "p_size % 30 AS lga_code", "element_at(array('approved', 'recommended', 'conditional', 'approval_required', 'not_recommended', 'maybe'), p_size % 6 + 1) AS guidance_status", "element_at(array('small', 'medium', 'large', 'huge'), p_size % 4 + 1) AS mature_size_class",
        "p_name AS scientific_name", "p_brand AS common_name", "DATE '2024-02-01' AS effective_from", "CASE WHEN p_size % 5 = 0 THEN DATE '2024-01-01' END AS effective_to",
    )
    lga = t("lga").selectExpr("lga_id AS lga_code")
    x = inventories.normalise_guidance(rows, lga, ["approved", "recommended", "conditional", "approval_required", "not_recommended"], ["small", "medium", "large"])
    return x.select("p_partkey", F.array_join("reject_reasons", "; ").alias("reasons"))


@query("c_custkey:l, tile_x:l, tile_y:l", """
    SELECT c_custkey, floor((144.5 + c_custkey % 1000 / 1000.0::DOUBLE + 180) / 360 * 65536) tile_x, floor((1 - asinh(tan(radians(-38.2 + c_custkey % 997 / 1000.0::DOUBLE))) / pi()) / 2 * 65536) tile_y FROM customer""")
def web_tiles(t):
    lon, lat = F.expr("144.5D + c_custkey % 1000 / 1000D"), F.expr("-38.2D + c_custkey % 997 / 1000D")
    x, y = geo.web_tile(lon, lat, 16)
    return t("customer").select("c_custkey", x.alias("tile_x"), y.alias("tile_y"))


@query("parcel_id:l, area_m2:d, x:d, y:d, valid:b, covers:b, clipped_m2:d", """
    SELECT parcel_id, area_m2, x, y, true AS valid, parcel_id % 2 = 0 AS covers, area_m2 / 4.0 clipped_m2 FROM parcel""", "parcel")
def parcel_polygons(t):
    x = t("parcel").repartition("parcel_id")  # a small file is one task's, and most of the work is each row's
    x = x.withColumn("polygon", geo.box_polygon("xmin", "ymin", "xmax", "ymax"))
    inner = geo.interior_point(F.col("polygon"))
    at = F.when(F.col("parcel_id") % 2 == 0, F.col("xmin")).otherwise(F.col("xmin") - 1)
    quarter = geo.clip_to_convex(F.col("polygon")[0], geo.box_polygon(F.col("x"), F.col("y"), F.col("xmax") + 9, F.col("ymax") + 9)[0])
    return x.select(
        "parcel_id", geo.polygon_area(F.col("polygon")).alias("area_m2"), inner["x"].alias("x"), inner["y"].alias("y"), geo.valid_polygon(F.col("polygon")).alias("valid"),
        geo.in_polygon(F.col("polygon"), at, F.col("ymin")).alias("covers"), geo.ring_area(quarter).alias("clipped_m2"),
    )


# Kruger's series written out for GRS80 (third flattening 0.00167922039462874) and the zone around 147 E.
@query("c_custkey:l, easting:d, northing:d", """
    WITH p AS (SELECT c_custkey, radians(-38.2::DOUBLE + c_custkey % 997 / 1000.0::DOUBLE) phi, radians(144.5::DOUBLE + c_custkey % 1000 / 1000.0::DOUBLE - 147) lam, 0.0818191910428158::DOUBLE e FROM customer),
    q AS (SELECT c_custkey, lam, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) t FROM p), r AS (SELECT c_custkey, atan2(t, cos(lam)) xi, atanh(sin(lam) / sqrt(1 + t * t)) eta FROM q),
    k AS (SELECT *, 0.00167922039462874::DOUBLE n FROM r),
    a AS (SELECT *, n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180 a1, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440 a2, 61 * n ** 3 / 240 - 103 * n ** 4 / 140 a3, 49561 * n ** 4 / 161280 a4,
                 0.9996 * 6378137 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) scale FROM k)
    SELECT c_custkey, round(500000 + scale * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta) + a4 * cos(8 * xi) * sinh(8 * eta)), 3) easting,
           round(10000000 + scale * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta) + a4 * sin(8 * xi) * cosh(8 * eta)), 3) northing FROM a""")  # fmt: skip
def map_grid(t):
    x, y = geo.to_map_grid(F.expr("144.5D + c_custkey % 1000 / 1000D"), F.expr("-38.2D + c_custkey % 997 / 1000D"))
    return t("customer").select("c_custkey", F.round(x, 3).alias("easting"), F.round(y, 3).alias("northing"))


@query("model_code:s, missing:s, unlicensed:s, n_blockers:l, ready:b", """
    WITH d AS (SELECT DISTINCT p_type dataset, p_type <> 'STANDARD' available, p_type <> 'PROMO' licensed FROM part), m AS (SELECT DISTINCT p_brand model_code, p_type dataset FROM part)
    SELECT model_code, string_agg(DISTINCT CASE WHEN NOT available THEN dataset END, ',' ORDER BY CASE WHEN NOT available THEN dataset END) missing, string_agg(DISTINCT CASE WHEN available AND NOT licensed THEN dataset END, ',' ORDER BY CASE WHEN available AND NOT licensed THEN dataset END) unlicensed,
           count_if(NOT available OR NOT licensed) n_blockers, count_if(NOT available OR NOT licensed) = 0 ready FROM m JOIN d USING (dataset) GROUP BY 1""")  # fmt: skip
def model_readiness(t):
    part = t("part")
    d = part.selectExpr("p_type AS dataset", "p_type <> 'STANDARD' AS available", "p_type <> 'PROMO' AS licensed").distinct()
    m = part.groupBy(F.col("p_brand").alias("model_code")).agg(F.collect_set("p_type").alias("required"))
    r = scenarios.readiness(m, d)
    return r.withColumns({"missing": F.nullif("missing", F.lit("")), "unlicensed": F.nullif("unlicensed", F.lit(""))})


@query("n_pass:l, n_warn:l, n_fail:l, o_orderpriority:s, status:s", """
    SELECT o_orderpriority, count_if(s = 'PASS') n_pass, count_if(s = 'WARN') n_warn, count_if(s = 'FAIL') n_fail, CASE WHEN count_if(s = 'FAIL') > 0 THEN 'FAIL' WHEN count_if(s = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END status
    FROM (SELECT o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'WARN' ELSE CASE WHEN o_custkey % 100 = 7 THEN 'FAIL' ELSE 'PASS' END END s FROM orders) GROUP BY 1""")  # fmt: skip
def status_roll_up(t):
    x = t("orders").selectExpr("o_orderpriority", "CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'WARN' ELSE CASE WHEN o_custkey % 100 = 7 THEN 'FAIL' ELSE 'PASS' END END AS status")
    return quality.roll_up(x, ["o_orderpriority"])


# -- jobs -----------------------------------------------------------------------------------------------------------


@query("version_id:l, n_in:l, n_out:l, n_excluded:l, retention_pct:d", f"""
    WITH f AS (SELECT floor(x / 20000) version_id, EXISTS (SELECT 1 FROM lga WHERE lga_id % 2 = 0 AND {_IN}) k FROM urban_tree)
    SELECT version_id, count(*) n_in, count_if(k) n_out, count_if(NOT k) n_excluded, round(count_if(k) / count(*) * 100, 2) retention_pct FROM f GROUP BY 1""", "urban_tree lga")  # fmt: skip
def clip_report(t):
    facts = t("urban_tree").withColumn("version_id", F.floor(F.col("x") / 20000))
    return pipelines.clip(facts, t("lga").where("lga_id % 2 = 0"), "clip")[1]


@query("orderkey:l, n:l", """
    SELECT l_orderkey orderkey, count(*) n FROM lineitem WHERE l_quantity <= 48 AND (l_orderkey * 31) % 60000 < 36000 AND (SELECT count_if(l_quantity <= 48) / count(*) FROM lineitem) >= 0.9 GROUP BY 1""")
def gated_ingest(t):
    rows = t("lineitem").selectExpr("l_orderkey AS orderkey", "l_quantity AS quantity", "(l_orderkey * 31) % 60000 AS x", "1D AS y")
    boundary = t("lga").where("ymin = 0").groupBy().agg(F.lit(0).alias("xmin"), F.lit(0).alias("ymin"), F.lit(35999).alias("xmax"), F.lit(12000).alias("ymax"))
    facts, _ = pipelines.ingest(rows, [{"code": "Q", "type": "range", "field": "quantity", "maximum": 48}], "lineitem", "v1", boundary, 90.0)
    return facts.groupBy("orderkey").agg(F.count("*").alias("n"))


@query("cell_id:l, observed_on:t, band:s", """
    WITH q AS (SELECT quantile_cont(heat_value, 1.0::DOUBLE / 3) a, quantile_cont(heat_value, 2.0::DOUBLE / 3) b FROM heat)
    SELECT cell_id, observed_on, max(CASE WHEN heat_value <= a THEN '1Low' WHEN heat_value <= b THEN '2Medium' ELSE '3High' END) band FROM heat, q GROUP BY ALL""", "heat")
def scheme_bands(t):
    scheme = pipelines.classification_scheme(t("heat"), ["heat_value"], "v1")
    x = pipelines.by_scheme(t("heat"), scheme, "heat_value")
    rank = F.concat(F.when(F.col("band") == "Low", "1").when(F.col("band") == "Medium", "2").otherwise("3"), "band")
    return x.groupBy("cell_id", "observed_on").agg(F.max(rank).alias("band"))


@query("parcel_id:l, n_trees:l, crown_pct:d", """
    SELECT p.parcel_id, count(t.x) n_trees, round(coalesce(sum(pi() * radius * radius), 0) / any_value(area_m2) * 100, 2) crown_pct FROM parcel p LEFT JOIN urban_tree t ON t.x BETWEEN xmin AND xmax AND t.y BETWEEN ymin AND ymax GROUP BY ALL""", "parcel urban_tree")
def lot_canopy(t):
    return pipelines.lot_canopy(t("parcel"), t("urban_tree"))


@query("parcel_id:l, failures:s, warnings:s, status:s", """
    WITH x AS (SELECT parcel_id, parcel_id % 23 matches, parcel_id % 11 > 0 inside, area_m2 - 500 a, CASE WHEN area_m2 <= 800 THEN 'medium' ELSE 'large' END lot, 144.2 + parcel_id % 100 / 50.0 lon, nullif(parcel_id % 90, 7) h,
                      CASE parcel_id % 13 WHEN 0 THEN 'Unavailable' WHEN 1 THEN 'Odd' ELSE 'Low' END hc, nullif(parcel_id % 101, 50) c, nullif(parcel_id % 103, 51) pc, parcel_id % 17 = 0 proxy, CASE WHEN parcel_id % 19 > 0 THEN 'v1' END v,
                      nullif(parcel_id % 4, 3) n, parcel_id % 30 km, DATE '2023-01-01' + CAST(parcel_id % 500 AS INTEGER) d FROM parcel),
    s AS (SELECT *, CASE WHEN km <= 10 THEN 'good_local_context' WHEN km < 25 THEN 'regional_context_warning' WHEN km < 28 THEN 'too_distant_temperature_suppressed' ELSE 'odd' END w, CASE WHEN km < 27 AND km <> 4 THEN 20 END air FROM x),
    y AS (SELECT parcel_id, concat_ws(',', CASE WHEN matches = 0 THEN 'not_one_match' END, CASE WHEN NOT inside THEN 'outside_boundary' END, CASE WHEN a <= 0 THEN 'bad_area' END, CASE WHEN lot <> 'medium' THEN 'other_lot_size' END, CASE WHEN lon > 146 THEN 'bad_coordinates' END,
                 CASE WHEN h IS NULL OR h > 80 THEN 'bad_heat' END, CASE WHEN h IS NULL AND hc <> 'Unavailable' OR h IS NOT NULL AND hc NOT IN ('Low', 'Medium', 'High') THEN 'bad_heat_class' END, CASE WHEN d > DATE '2024-02-01' THEN 'bad_heat_date' END,
                 CASE WHEN c IS NULL OR c > 100 THEN 'bad_canopy' END, CASE WHEN c IS NULL THEN 'bad_canopy_class' END, CASE WHEN pc IS NULL OR pc > 100 THEN 'bad_property_canopy' END, CASE WHEN proxy THEN 'property_canopy_is_proxy' END, CASE WHEN v IS NULL THEN 'no_scheme_version' END,
                 CASE WHEN n IS NULL THEN 'bad_tree_count' END, CASE WHEN w = 'odd' OR w = 'good_local_context' AND air IS NULL OR w = 'too_distant_temperature_suppressed' AND (air IS NOT NULL OR km <= 25) OR w = 'regional_context_warning' AND km <= 10 THEN 'weather_contradiction' END) failures,
                 concat_ws(',', CASE WHEN DATE '2024-02-01' - d > 365 THEN 'old_heat' END, CASE WHEN c <= 1 OR c >= 90 THEN 'extreme_canopy' END, CASE WHEN pc <= 1 OR pc >= 90 THEN 'extreme_property_canopy' END, CASE WHEN n = 0 THEN 'no_trees' END,
                 CASE WHEN w = 'regional_context_warning' AND km > 10 OR w = 'too_distant_temperature_suppressed' AND km > 25 THEN 'distant_weather' END) warnings FROM s)
    SELECT *, CASE WHEN failures <> '' THEN 'FAIL' WHEN warnings <> '' THEN 'WARN' ELSE 'PASS' END status FROM y""", "parcel")  # fmt: skip
def property_sanity(t):
    x = t("parcel").selectExpr(
        "parcel_id", "CAST(IF(parcel_id % 23 = 0, 2, 1) AS BIGINT) AS n_matches", "parcel_id % 11 > 0 AS inside_boundary", "CAST(area_m2 - 500 AS DOUBLE) AS area_m2", "IF(area_m2 <= 800, 'medium', 'large') AS lot_size", "'medium' AS expected_lot_size",
        "144.2D + parcel_id % 100 / 50D AS longitude", "-38D AS latitude", "CAST(nullif(parcel_id % 90, 7) AS DOUBLE) AS heat_value", "CASE parcel_id % 13 WHEN 0 THEN 'Unavailable' WHEN 1 THEN 'Odd' ELSE 'Low' END AS heat_class",
        "CAST(nullif(parcel_id % 101, 50) AS DOUBLE) AS canopy_pct", "'Low' AS canopy_class", "CAST(nullif(parcel_id % 103, 51) AS DOUBLE) AS property_canopy_pct", "parcel_id % 17 = 0 AS is_proxy", "CASE WHEN parcel_id % 19 > 0 THEN 'v1' END AS scheme_version",
        "nullif(parcel_id % 4, 3) AS n_trees", "CAST(parcel_id % 30 AS DOUBLE) AS distance_km", "date_add(DATE '2023-01-01', CAST(parcel_id % 500 AS INT)) AS heat_observed_on",
    ).selectExpr(
        "*", "CASE WHEN distance_km <= 10 THEN 'good_local_context' WHEN distance_km < 25 THEN 'regional_context_warning' WHEN distance_km < 28 THEN 'too_distant_temperature_suppressed' ELSE 'odd' END AS weather_status",
        "CASE WHEN distance_km < 27 AND distance_km <> 4 THEN 20D END AS air_temperature_c",
    )
    return pipelines.property_sanity(x, F.lit("2024-02-01").cast("date"))


@query("c_custkey:l, area_m2:d, difference_pct:d, keyed:b", """
    SELECT c_custkey, c_acctbal area_m2, CASE WHEN c_nationkey > 0 THEN abs(c_acctbal - c_nationkey * 100) / (c_nationkey * 100) * 100 END difference_pct, true AS keyed FROM customer""")
def canopy_snapshots(t):
    x = t("customer").selectExpr("c_custkey", "map('shape_area', CAST(c_acctbal AS STRING)) AS properties", "c_name AS geometry", "CAST(c_nationkey * 100 AS DOUBLE) AS measured_m2")
    n = inventories.normalise_canopy_snapshot(x, 2021)
    keyed = x.select("c_custkey", F.sha2("geometry", 256).alias("source_feature_key"))
    return n.join(keyed, "source_feature_key").selectExpr("c_custkey", "source_area_m2 AS area_m2", "source_area_difference_pct AS difference_pct", "length(source_feature_key) = 64 AS keyed")


@query("lga_code:s, lga_official_name:s, source_feature_id:s", "SELECT CAST(n_nationkey AS VARCHAR) lga_code, CASE WHEN n_nationkey % 2 = 0 THEN 'City of ' || n_name ELSE n_name END lga_official_name, CASE WHEN n_nationkey % 3 = 0 THEN 'U' || n_nationkey ELSE CAST(n_nationkey AS VARCHAR) END source_feature_id FROM nation")
def lga_features(t):
    x = t("nation").selectExpr("map_concat(map('LGA_CODE', CAST(n_nationkey AS STRING), 'Lga_Name', n_name), IF(n_nationkey % 2 = 0, map('LGA_OFFICIAL_NAME', concat('City of ', n_name)), map('LGA_OFFICIAL_NAME', ' ')), IF(n_nationkey % 3 = 0, map('ufi', concat('U', n_nationkey)), map('x', 'y'))) AS properties", "'g' AS geometry")
    return inventories.normalise_lga(x)


@query("lga_code:l, species_key:s, guidance_status:s, n_trees:l", """
    WITH g AS (SELECT p_size % 25 lga_code, 'scientific:' || lower(p_name) species_key, CASE p_partkey % 2 WHEN 0 THEN 'approved' ELSE 'conditional' END s FROM part), o AS (SELECT l_partkey % 30 lga_code, 'scientific:' || lower(scientific_name) species_key, count(*) n FROM tree GROUP BY ALL)
    SELECT g.lga_code, g.species_key, s guidance_status, coalesce(n, 0) n_trees FROM g LEFT JOIN o USING (lga_code, species_key) UNION ALL SELECT lga_code, species_key, 'not_in_loaded_guidance', n FROM o WHERE (lga_code, species_key) NOT IN (SELECT lga_code, species_key FROM g)""", "tree")  # fmt: skip
def guidance_options(t):
    g = t("part").selectExpr("CAST(p_size % 25 AS BIGINT) AS lga_code", "p_name AS scientific_name", "p_brand AS common_name", "CASE p_partkey % 2 WHEN 0 THEN 'approved' ELSE 'conditional' END AS guidance_status")
    o = t("tree").groupBy((F.col("l_partkey") % 30).alias("lga_code"), species.species_key().alias("species_key")).agg(F.count("*").alias("n_trees"))
    return species.species_options(g, o)


@query("scenario_id:l, added_m2:d, added_pct:d, total_pct:d, carbon_kg:d", """
    WITH s AS (SELECT l_suppkey scenario_id, sum(pi() * l_quantity * l_quantity / 100) a FROM lineitem GROUP BY 1)
    SELECT scenario_id, round(a, 2) added_m2, round(a / 90000 * 100, 2) added_pct, round(least(10 + a / 90000 * 100, 100), 2) total_pct, round(a, 2) * 0.65 carbon_kg FROM s""")
def scenario_canopy(t):
    x = t("lineitem").selectExpr("l_suppkey AS scenario_id", "l_quantity / 10 AS radius", "90000D AS site_area_m2", "10D AS baseline_pct")
    return scenarios.benefits(scenarios.scenario_canopy(x))


# -- streams --------------------------------------------------------------------------------------------------------


def _stream(name: str, sql: str, columns: str):
    """Register a stream over ``events`` that is run to its end; its batches are written to a shared folder and read back."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from greenlake.sources.scratch import scratch_path

            source = spark.read.parquet(f"{sf_dir}/events.parquet")
            stream = weather_stream.observations(spark, f"{sf_dir}/events.parquet*", source.schema)
            x = stream.selectExpr("CAST(user_id % 40 AS STRING) AS station_code", "CAST(ts AS TIMESTAMP) AS observed_at", "value / 10 AS air_temperature_c", "event_id")
            out = scratch_path(spark, name)
            return fn(spark, x, out)

        pairs = [c.strip().split(":") for c in columns.split(",")]
        cast = ", ".join(f"{_DUCK[k].format(c)} AS {c}" for c, k in pairs)
        shaped = lambda spark, d: run(spark, d).selectExpr(*(f"{_SPARK[k].format(c)} AS {c}" for c, k in pairs))
        QUERIES[name] = Query(shaped, f"WITH _result AS ({sql}) SELECT {cast} FROM _result")
        return fn

    return register


@_stream("stream_latest", "SELECT CAST(user_id % 40 AS VARCHAR) station_code, max(event_id) event_id FROM events e WHERE ts = (SELECT max(ts) FROM events g WHERE g.user_id % 40 = e.user_id % 40) GROUP BY 1", "station_code:s, event_id:l")
def stream_latest(spark, x, out):
    with weather_stream.rocksdb_state(spark):
        q = weather_stream.newest(x.where(F.col("observed_at") <= F.current_timestamp())).writeStream.outputMode("update").foreachBatch(weather_stream.changes(f"{out}/state"))
        q.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return weather_stream.newest_state(spark, f"{out}/state")


@_stream("stream_days_closed", """
    WITH x AS (SELECT DISTINCT ON (user_id % 40, ts) user_id % 40 s, ts, value / 10 v FROM events)
    SELECT CAST(s AS VARCHAR) station_code, CAST(ts AS DATE) observed_on, avg(v) mean_c, min(v) min_c, max(v) max_c, count(*) n FROM x
    WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 3 HOUR FROM events) GROUP BY ALL""", "station_code:s, observed_on:t, mean_c:d, min_c:d, max_c:d, n:l")  # fmt: skip
def stream_days_closed(spark, x, out):
    """Days past the watermark only, each written once."""
    days = weather_stream.daily(weather_stream.without_repeats(weather_stream.timely(x))).writeStream.outputMode("append").format("parquet")
    days.option("path", f"{out}/days").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/days")


@_stream("stream_daily", """
    WITH x AS (SELECT DISTINCT ON (user_id % 40, ts) user_id % 40 s, ts, value / 10 v FROM events)
    SELECT CAST(s AS VARCHAR) station_code, CAST(ts AS DATE) observed_on, avg(v) mean_c, min(v) min_c, max(v) max_c, count(*) n FROM x GROUP BY ALL""", "station_code:s, observed_on:t, mean_c:d, min_c:d, max_c:d, n:l")  # fmt: skip
def stream_daily(spark, x, out):
    daily = weather_stream.daily(weather_stream.without_repeats(weather_stream.timely(x)))

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/days/batch_no={number}")

    q = daily.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.parquet(f"{out}/days").drop("batch_no")
    return rows.groupBy("station_code", "observed_on").agg(F.max_by(F.struct("mean_c", "min_c", "max_c", "n"), "batch").alias("d")).select("station_code", "observed_on", "d.*")


@_stream("stream_gated", "SELECT CAST(user_id % 40 AS VARCHAR) station_code, count(*) n FROM events WHERE value / 10 BETWEEN 0 AND 60 GROUP BY 1", "station_code:s, n:l")
def stream_gated(spark, x, out):
    rules = [{"code": "RANGE", "type": "range", "field": "air_temperature_c", "minimum": 0, "maximum": 60}]
    write = weather_stream.gated(rules, f"{out}/facts", f"{out}/evidence", "weather", 50.0)
    x.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/facts").groupBy("station_code").agg(F.count("*").alias("n"))


def registered() -> dict[str, Query]:
    from greenlake.plans import more_queries, spatial_queries  # noqa: F401  register their own

    return QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in registered().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in registered().items() if q.sql}

