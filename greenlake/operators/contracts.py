"""Nested objects: model contracts, and answers held against expected cases path by path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels of nesting that are followed; deeper objects are compared as text.
DEPTH = 16


def flattened(df: DataFrame, key: str, column: str, depth: int = DEPTH) -> DataFrame:
    """Rows (key, path, kind, text) of all nodes of JSON texts: the object itself (an empty path), and every value in it.

    kind is object, array, number, string, boolean or null; an array is one value. A null or broken text has no rows.
    """
    level = df.select(F.col(key).alias("key"), F.try_parse_json(column).alias("v"), F.array().cast("array<string>").alias("path")).where("v is not null")
    said = F.schema_of_variant("v")
    kind = (
        F.when(said.startswith("OBJECT"), "object").when(said.startswith("ARRAY"), "array").when(said == "STRING", "string")
        .when(said == "BOOLEAN", "boolean").when(said == "VOID", "null").otherwise("number")
    )
    out = None
    for i in range(depth + 1):
        level = level.withColumn("kind", kind)
        text = F.when(F.col("kind") == "string", F.col("v").cast("string")).otherwise(F.to_json("v"))
        rows = level.select("key", "path", "kind", text.alias("text"))
        out = rows if out is None else out.unionByName(rows)
        if i < depth:
            inner = level.where("kind = 'object'")
            if inner.isEmpty():
                break
            level = df.sparkSession.sql("SELECT t.key, concat(t.path, array(e.key)) AS path, e.value AS v FROM {t} AS t, LATERAL variant_explode(t.v) AS e", t=inner)
    return out


def compare_nested(actual: DataFrame, expected: DataFrame, key: str, column: str, tolerance: float = 0.001) -> DataFrame:
    """Each expected case with its failures (``path:reason``, in order of path) and whether it passed.

    Both tables have a key and a JSON text. What is expected must be a part of what is there: keys that only the actual object has are
    no matter. Numbers may differ by ``tolerance``; a number in a text counts as one. Reasons are missing, object (one was expected),
    number and value; below a node that fails nothing more is said. A case without an answer is missing as a whole.
    """
    a = flattened(actual, key, column).select("key", "path", F.col("kind").alias("a_kind"), F.col("text").alias("a_text"))
    e = flattened(expected, key, column).withColumn("parent", F.when(F.size("path") > 0, F.slice("path", F.lit(1), F.size("path") - 1)))
    up = a.where("a_kind = 'object'").select("key", F.col("path").alias("parent"), F.lit(True).alias("within"))
    x = e.join(a, ["key", "path"], "left").join(up, ["key", "parent"], "left").where("parent is null or within")
    number = F.col("a_text").try_cast("double")
    reason = (
        F.when(F.col("a_kind").isNull(), "missing").when((F.col("kind") == "object") & (F.col("a_kind") != "object"), "object").when(F.col("kind") == "object", None)
        .when(F.col("kind") == "number", F.when(~F.coalesce(F.abs(number - F.col("text").cast("double")) <= tolerance, F.lit(False)), "number"))
        .when((F.col("kind") != F.col("a_kind")) | (F.col("text") != F.col("a_text")), "value")
    )
    wrong = x.withColumn("reason", reason).where("reason is not null").select("key", F.concat(F.array_join("path", "."), F.lit(":"), F.col("reason")).alias("f"))
    # As many entries as the expected object has values.
    wrong = wrong.groupBy("key").agg(F.array_join(F.sort_array(F.collect_list("f")), ",").alias("failures"))
    out = expected.select(F.col(key).alias("key")).join(wrong, "key", "left")
    return out.select(F.col("key").alias(key), F.coalesce("failures", F.lit("")).alias("failures"), F.col("failures").isNull().alias("passed"))


def model_contracts(specifications: DataFrame, models: DataFrame, links: DataFrame, sources: DataFrame) -> DataFrame:
    """Each specified model with its version's columns and ``source_contract``: its sources as a JSON array in order of their names.

    ``specifications`` has model_code and model_version_id, ``links`` model_code, source_id, source_role, required_for_training and
    training_use_allowed, ``sources`` source_id, source_name, licence and licence_status. A model without sources has an empty array;
    a link to an unknown source is no source, and a specification of an unknown version no contract.
    """
    entry = F.struct("source_name", "source_role", F.col("required_for_training").alias("required"), "licence", "licence_status", "training_use_allowed")
    each = links.join(sources, "source_id").groupBy("model_code").agg(F.to_json(F.sort_array(F.collect_list(entry)), {"ignoreNullFields": "false"}).alias("source_contract"))
    x = specifications.join(models, "model_version_id").drop("model_version_id").join(each, "model_code", "left")
    return x.withColumn("source_contract", F.coalesce("source_contract", F.lit("[]")))
