"""Helpers shared by the corpus operators: scratch tables, Arrow row maps, bitmaps, components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from greenlake.sources.scratch import written

__all__ = ["bitmap_of", "connected_components", "fresh", "map_batches", "with_component_id", "written"]

#: Bytes of one Arrow batch that a task gets at once; one text may be longer.
BATCH_BYTES = 4 << 20
#: Parts of each component's rows when they are joined to its smallest id.
PARTS = 32


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened by ``_`` until no column has it (column names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(df: DataFrame, make, schema: str | T.StructType) -> DataFrame:
    """Apply ``make()(*columns) -> output columns`` to each Arrow batch of ``df``.

    ``make`` runs once in each task and returns the function, so it may load tables once; it may also return
    a pair of that function and one that gives the columns that are left when the task's batches are over.
    Sets the session's bytes of an Arrow batch, as texts may be long.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    out = to_arrow_schema(kind)

    def run(batches):
        made = make()
        fn, rest = made if isinstance(made, tuple) else (made, None)

        def packed(cols):
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, out)], schema=out
            )

        for batch in batches:
            yield packed(fn(*(c.to_pylist() for c in batch.columns)))
        if rest:
            yield packed(rest())

    return df.mapInArrow(run, kind)


def bitmap_of(df: DataFrame, column: str, bits: int) -> bytes:
    """A bitmap of ``2**bits`` bits with a bit set for each value of a long column.

    Built by a distributed aggregate; the driver receives ``2**bits / 8`` bytes whatever the row count.
    """
    at = F.pmod(F.col(column), F.lit(1 << bits)) + 1
    rows = (
        df.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        .collect()
    )
    out = bytearray((1 << bits) // 8)
    for r in rows:
        start = (r["bucket"] - 1) * 4096
        piece = bytes(r["bits"])[: len(out) - start]
        out[start : start + len(piece)] = piece
    return bytes(out)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Components of an undirected graph given as long columns ``u`` and ``v``.

    Alternates large-star and small-star steps on written tables until every edge points to its
    component's smallest id. Each step is a partially aggregated minimum and an equi-join, so a node
    with very many edges is never gathered. Returns ``id`` and ``component`` for ids that have edges.
    """
    e = written(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        name,
    )
    while True:
        # Done when every id points to one other and none that is pointed to points on.
        ups = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ups = ups.unionByName(e.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        open_ = ups.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not open_.where("up > 1 or (up = 1 and down = 1)").limit(1).count():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), name)
    ends = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def with_component_id(rows: DataFrame) -> DataFrame:
    """``rows`` (id, root, ...) with the smallest id of their root, or their own without one, as component_id.

    A component may hold a third of all rows, so its rows are dealt over PARTS parts, of which each that has
    rows gets the smallest id. Joined by merging, as these are about as many as the rows.
    """
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int"))
    least = rows.where("root is not null").groupBy("root", "_part").agg(F.min("id").alias("_least"))
    least = least.withColumn("_least", F.min("_least").over(Window.partitionBy("root")))
    out = rows.join(least.hint("merge"), ["root", "_part"], "left")
    return out.withColumn("component_id", F.coalesce("_least", "id")).drop("_part", "_least")
