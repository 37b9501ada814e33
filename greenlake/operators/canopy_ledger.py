"""Grid canopy from many tiles over many runs: each tile's partial sums are kept once and merged when all are in."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenlake.operators.raster import NODATA
from greenlake.sources import publish


def fingerprint(tiles: DataFrame, **settings) -> str:
    """Identity of a build: its tiles with their digests, and its settings. One name and digest for each tile comes together."""
    names = tiles.select(F.concat_ws("\0", F.col("tile_id").cast("string"), "sha256").alias("t")).agg(F.sha2(F.array_join(F.sort_array(F.collect_set("t")), "\n"), 256)).first()[0]
    return hashlib.sha256(json.dumps({"tiles": names, **settings}, sort_keys=True).encode()).hexdigest()


def done_tiles(spark: SparkSession, table: str, build: str) -> DataFrame:
    """Tiles whose sums are published for a build."""
    runs = publish.published_runs(spark, table).where(F.startswith("run_id", F.lit(f"{build}|")))
    return runs.select(F.substring("run_id", len(build) + 2, 1 << 30).alias("tile"))


def add_tiles(table: str, tiles: DataFrame, pixels: DataFrame, size: float = 500.0, tree_value: int = 1, only: DataFrame | None = None) -> str:
    """Publish the partial sums of the tiles that are not done yet, all or those in ``only``; returns the build's fingerprint.

    ``tiles`` (tile_id, sha256) are all tiles of the build, ``pixels`` has tile_id, x, y and value. Pixels of tiles that are done are
    filtered out before anything is summed. Other tiles, digests or settings make another build, which shares nothing with this one. A run
    that dies publishes nothing; one that is repeated adds nothing.
    """
    spark = tiles.sparkSession
    build = fingerprint(tiles, size=size, tree_value=tree_value)
    todo = tiles.select("tile_id").distinct() if only is None else only.select("tile_id").distinct().join(tiles.select("tile_id").distinct(), "tile_id", "left_semi")
    todo = todo.join(done_tiles(spark, table, build), F.col("tile_id").cast("string") == F.col("tile"), "left_anti")
    names = sorted(str(r["tile_id"]) for r in todo.collect())  # ids of a catalogue's tiles
    if not names:
        return build
    version = f"{build}-{hashlib.sha256(json.dumps(names).encode()).hexdigest()[:16]}"
    own = pixels.where(F.col("value") != NODATA).join(F.broadcast(todo), "tile_id", "left_semi")
    sums = own.groupBy("tile_id", F.floor(F.col("x") / size).cast("long").alias("cell_x"), F.floor(F.col("y") / size).cast("long").alias("cell_y")).agg(
        F.count("*").alias("n_valid"), F.count_if(F.col("value") == tree_value).alias("n_tree")
    )
    facts = sums.withColumns({"tile_id": F.col("tile_id").cast("string"), "build": F.lit(build), "version_id": F.lit(version)})
    publish.publish(facts, table, [{"run_id": f"{build}|{n}", "version_id": version} for n in names])
    return build


def merged(spark: SparkSession, table: str, build: str, tiles: DataFrame, size: float = 500.0, pixel_area: float = 1.0) -> DataFrame:
    """Cells of a build with their canopy share and coverage, once all its tiles are in; no rows before."""
    kind = "cell_x long, cell_y long, canopy_pct double, coverage_pct double, n_tiles long"
    open_ = tiles.select(F.col("tile_id").cast("string").alias("tile")).distinct().join(done_tiles(spark, table, build), "tile", "left_anti")
    if not open_.isEmpty() or publish.manifest(spark, table)["schema"] is None:
        return spark.createDataFrame([], kind)
    x = publish.read_published(spark, table).where(F.col("build") == build).groupBy("cell_x", "cell_y").agg(F.sum("n_valid").alias("v"), F.sum("n_tree").alias("t"), F.count("*").alias("n_tiles"))
    return x.select("cell_x", "cell_y", F.round(F.col("t") / F.col("v") * 100, 2).alias("canopy_pct"), F.round(F.least(F.lit(1.0), F.col("v") * pixel_area / size**2) * 100, 2).alias("coverage_pct"), "n_tiles")
