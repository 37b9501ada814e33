"""Raster work as jobs over pixel tables (x, y, value and quality bits)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenlake.operators.spatial_join import sums_in_areas

# Surface-temperature scaling, plausible range, and the quality bits that spoil a pixel.
LST_SCALE, LST_OFFSET, KELVIN = 0.00341802, 149.0, 273.15
LST_MIN, LST_MAX = -50.0, 80.0
BAD_BITS = sum(1 << b for b in (0, 1, 2, 3, 4, 5, 7))

# Land-cover classes and their column names.
LAND_COVER = {
    111: "cultivated_vegetation_pct", 112: "natural_terrestrial_vegetation_pct", 124: "natural_aquatic_vegetation_pct",
    215: "artificial_surface_pct", 216: "natural_bare_surface_pct", 220: "water_pct",
}
NODATA = 255


def decode_lst(pixels: DataFrame) -> DataFrame:
    """Clear pixels with their temperature in Celsius, within the plausible range."""
    t = F.col("dn") * LST_SCALE + (LST_OFFSET - KELVIN)
    clear = pixels.where((F.col("dn") > 0) & (F.col("qa").bitwiseAND(F.lit(BAD_BITS)) == 0))
    return clear.withColumn("lst_c", t).where(F.col("lst_c").between(LST_MIN, LST_MAX))


def _cell(x: str, size: float):
    return (F.floor(F.col(x) / size) * int(size)).cast("long")


def cell_mean(pixels: DataFrame, value: str, size: float = 500.0, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean of the pixel centres in each cell, three digits, with the cell's box."""
    x = pixels.withColumns({"xmin": _cell("x", size), "ymin": _cell("y", size)})
    out = x.groupBy(*keys, "xmin", "ymin").agg(F.round(F.avg(value), 3).alias("value"), F.count("*").alias("n_pixels"))
    return out.withColumns({"xmax": F.col("xmin") + int(size), "ymax": F.col("ymin") + int(size)})


def choose_scenes(scenes: DataFrame, most: int = 10) -> DataFrame:
    """Scenes of the best tier present, the newest and clearest of each path and row, newest first."""
    tier = scenes.agg(F.max((F.col("tier") == "T1").cast("int")).alias("_has"))
    x = scenes.join(F.broadcast(tier), F.lit(True)).where((F.col("_has") == 0) | (F.col("tier") == "T1")).drop("_has")
    w = Window.partitionBy("path", "row").orderBy(F.desc("acquired_on"), "cloud_cover", "scene_id")
    x = x.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return x.orderBy(F.desc("acquired_on"), "cloud_cover", "scene_id").limit(most)


def canopy_percent(pixels: DataFrame, tree_value: float = 1.0, size: float = 500.0) -> DataFrame:
    """Mean of the values over the tree value, in percent between 0 and 100, two digits."""
    x = pixels.where(F.col("value") != NODATA).withColumns({"xmin": _cell("x", size), "ymin": _cell("y", size)})
    share = F.avg("value") / F.lit(tree_value) * 100
    return x.groupBy("xmin", "ymin").agg(F.round(F.least(F.greatest(share, F.lit(0.0)), F.lit(100.0)), 2).alias("canopy_pct"))


def canopy_from_tiles(pixels: DataFrame, tree_value: float = 1.0, size: float = 500.0, pixel_area: float = 1.0, tiles: int | None = None) -> DataFrame:
    """Canopy of each cell weighted by valid area over its tiles, with a confidence; nothing until ``tiles`` tiles are in."""
    x = pixels.withColumns({"xmin": _cell("x", size), "ymin": _cell("y", size), "ok": F.col("value") != NODATA})
    part = x.groupBy("tile_id", "xmin", "ymin").agg(
        F.count_if("ok").alias("n_ok"), F.count_if(F.col("ok") & (F.col("value") == tree_value)).alias("n_tree")
    )
    # Weighted means of tile fractions by their valid area come to sums of counts.
    area = size * size / pixel_area
    out = part.groupBy("xmin", "ymin").agg(F.sum("n_ok").alias("n_ok"), F.sum("n_tree").alias("n_tree")).where("n_ok > 0")
    out = out.select("xmin", "ymin", F.round(F.col("n_tree") / F.col("n_ok") * 100, 2).alias("canopy_pct"), F.round(F.least(F.lit(1.0), F.col("n_ok") / F.lit(area)) * 100, 2).alias("confidence"))
    if tiles is None:
        return out
    done = pixels.agg(F.count_distinct("tile_id").alias("_n")).where(F.col("_n") >= tiles)
    return out.join(F.broadcast(done), F.lit(True)).drop("_n")


def unprocessed(pixels: DataFrame, ledger: DataFrame, fingerprint: str) -> DataFrame:
    """Pixels of tiles that the ledger does not list under this configuration."""
    return pixels.join(ledger.where(F.col("fingerprint") == fingerprint).select("tile_id"), "tile_id", "left_anti")


def infer_tree_class(pixels: DataFrame) -> DataFrame:
    """The tree value 1 where the values are only 0, 1 and no data; an error otherwise."""
    odd = pixels.agg(F.count_if(~F.col("value").isin(0, 1, NODATA)).alias("n"))
    return odd.select(F.when(F.col("n") > 0, F.raise_error(F.lit("tree class must be given for other values")).cast("int")).otherwise(1).alias("tree_value"))


def raster_profile(pixels: DataFrame, most: int = 32) -> DataFrame:
    """Extent and the smallest distinct values of each tile."""
    extent = pixels.groupBy("tile_id").agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"), F.count("*").alias("n_pixels"))
    values = pixels.select("tile_id", "value").distinct()
    w = Window.partitionBy("tile_id").orderBy("value")
    few = values.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most).groupBy("tile_id").agg(F.sort_array(F.collect_list("value")).alias("sample_values"))
    return extent.join(few, "tile_id", "left")


def land_cover_fractions(pixels: DataFrame, size: float = 500.0, year: str = "observed_year") -> DataFrame:
    """Percentages of the land-cover classes among each cell's valid pixels, and the dominant one, the first code on a tie."""
    x = pixels.withColumns({"xmin": _cell("x", size), "ymin": _cell("y", size), "ok": F.col("value").isin(*LAND_COVER)})
    n = x.groupBy("xmin", "ymin", year).agg(F.count_if(F.col("value") != NODATA).alias("n_valid"), F.count("*").alias("n_pixels"), *(F.count_if(F.col("value") == c).alias(f"n_{c}") for c in LAND_COVER))
    n = n.where("n_valid > 0")
    most = F.greatest(*(F.col(f"n_{c}") for c in LAND_COVER))
    dominant = reduce(lambda rest, c: F.when(F.col(f"n_{c}") == most, c).otherwise(rest), reversed(LAND_COVER), F.lit(None).cast("int"))
    key = F.concat_ws(":", F.lit("epsg7855"), F.col("xmin").cast("string"), F.col("ymin").cast("string"), F.lit(str(int(size))))
    return n.select(
        key.alias("cell_key"), year, *(F.round(F.col(f"n_{c}") / F.col("n_valid") * 100, 4).alias(name) for c, name in LAND_COVER.items()),
        F.round(F.col("n_valid") / F.col("n_pixels") * 100, 4).alias("valid_data_pct"), dominant.alias("dominant_level3_code"),
    )


def parcel_canopy(parcels: DataFrame, pixels: DataFrame, pixel_area: float, tree_value: int = 1, min_coverage: float = 95.0, most_pixels: int = 25_000_000, polygon: str | None = None) -> DataFrame:
    """Canopy of each parcel from the pixel centres inside it.

    Coverage is the share of the parcel's area that valid pixels cover. Below ``min_coverage`` the canopy is
    null and the status failed, never zero; so it is for a parcel outside the raster or one whose box would
    scan more than ``most_pixels``.
    """
    sums = {"n_ok": F.lit(1), "n_tree": (F.col("value") == tree_value).cast("int")}
    n = sums_in_areas(parcels, pixels.where(F.col("value") != NODATA), "parcel_id", sums, polygon=polygon)
    x = parcels.join(n, "parcel_id", "left")
    box = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) / pixel_area
    cover = F.least(F.lit(100.0), F.coalesce("n_ok", F.lit(0)) * pixel_area / F.col("area_m2") * 100)
    good = (cover >= min_coverage) & (box <= most_pixels)
    return x.select(
        "parcel_id", F.round(cover, 2).alias("coverage_pct"), F.when(good, F.round(F.col("n_tree") * pixel_area, 2)).alias("canopy_m2"),
        F.when(good, F.round(F.col("n_tree") / F.col("n_ok") * 100, 2)).alias("canopy_pct"), F.when(good, "passed").otherwise("failed").alias("status"),
    )


def publishable(canopy: DataFrame, parcels: DataFrame, min_rate: float = 95.0) -> DataFrame:
    """Whether all parcels are assessed and enough of them passed."""
    a = canopy.agg(F.count("*").alias("assessed"), F.count_if(F.col("status") == "passed").alias("passed"))
    b = parcels.agg(F.count("*").alias("parcels"))
    rate = F.col("passed") / F.nullif("assessed", F.lit(0)) * 100
    return a.join(F.broadcast(b), F.lit(True)).select("assessed", "passed", "parcels", F.round(rate, 2).alias("pass_rate"), ((F.col("assessed") == F.col("parcels")) & (F.coalesce(rate, F.lit(0.0)) >= min_rate)).alias("publish"))


def valid_sources(assets: DataFrame, most_metres: float = 2.0) -> DataFrame:
    """Analytical single-band projected rasters whose pixels are known and at most ``most_metres`` wide."""
    ok = (F.col("role") == "analytical") & (F.col("bands") == 1) & F.col("projected") & (F.col("pixel_m") > 0) & (F.col("pixel_m") <= most_metres)
    return assets.where(F.coalesce(ok, F.lit(False)))


def green_rate(pixels: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Share of pixels where green leads, and whether it is at least 99 percent."""
    share = F.avg(((F.col("g") > F.col("r")) & (F.col("g") > F.col("b"))).cast("double")) * 100
    return pixels.groupBy(*keys).agg(F.round(share, 2).alias("green_pct"), (share >= 99).alias("is_green"))


def top_colours(pixels: DataFrame, k: int = 10) -> DataFrame:
    return pixels.groupBy("r", "g", "b").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "r", "g", "b").limit(k)


def tiles_for(tiles: DataFrame, area: DataFrame) -> DataFrame:
    """Catalogue tiles (tile_id, box, updated_on) that the area's boxes touch, each id once by its newest entry, largest overlap first."""
    t = tiles.groupBy("tile_id").agg(F.max_by(F.struct("xmin", "ymin", "xmax", "ymax", "updated_on"), "updated_on").alias("t")).select("tile_id", "t.*")
    a = area.agg(F.min("xmin").alias("ax0"), F.min("ymin").alias("ay0"), F.max("xmax").alias("ax1"), F.max("ymax").alias("ay1"))
    x = t.join(F.broadcast(a), F.lit(True))  # one row
    wide = F.least("xmax", "ax1") - F.greatest("xmin", "ax0")
    tall = F.least("ymax", "ay1") - F.greatest("ymin", "ay0")
    x = x.withColumns({"_w": wide, "_h": tall}).where("_w > 0 and _h > 0")
    return x.select("tile_id", "xmin", "ymin", "xmax", "ymax", "updated_on", (F.col("_w") * F.col("_h")).alias("overlap_m2"))
