"""Readers and writers of the file formats that the data products use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names that hourly cubes give to each variable.
CUBE_NAMES = {
    "ts": ("valid_time", "time", "ts"), "lat": ("latitude", "lat"), "lon": ("longitude", "lon"), "t2m": ("t2m", "2m_temperature"), "tp": ("tp", "total_precipitation"),
    "swvl1": ("swvl1", "volumetric_soil_water_layer_1"), "ssrd": ("ssrd", "surface_solar_radiation_downwards"), "u10": ("u10", "10m_u_component_of_wind"), "v10": ("v10", "10m_v_component_of_wind"),
}

STATION = "struct<wmo:string,name:string,history_product:string,aifstime_utc:string,air_temp:string,apparent_t:string,rel_hum:string,wind_spd_kmh:string,rain_trace:string,lat:string,lon:string>"


def read_station_json(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``observations.data`` of station feeds, one file each or many under ``station_feeds``; a missing list is an error."""
    kind = f"struct<observations:struct<data:array<{STATION}>>>"
    schema = f"observations struct<data:array<{STATION}>>, station_feeds array<{kind}>"
    df = spark.read.schema(schema).json(path, multiLine=True)
    feeds = F.coalesce(F.transform("station_feeds", lambda f: f["observations"]["data"]), F.array(F.col("observations.data")))
    checked = F.transform(feeds, lambda d: F.when(d.isNull(), F.raise_error(F.lit("observations.data is missing")).cast(f"array<{STATION}>")).otherwise(d))
    return df.select(F.inline(F.flatten(checked)))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, also gzipped; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None, row_number: str | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header; with ``row_number`` the rows are numbered from 2, files in the order of their paths.

    A value may hold line ends unless ``multi_line`` is off; large files are then read by several tasks.
    """
    df = spark.read.csv(path, header=True, schema=schema, multiLine=multi_line, escape='"')
    bom = "\ufeff"
    if df.columns and df.columns[0].startswith(bom):
        df = df.withColumnRenamed(df.columns[0], df.columns[0].lstrip(bom))
    if row_number is None:
        return df
    # Numbering needs each block's place and size only; one row for each block of a file goes through the driver.
    at = df.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id()})
    before, starts = 2, []
    for r in sorted(at.groupBy("_file", "_block").agg(F.min("_at").alias("low"), F.count("*").alias("n")).collect()):
        starts.append((r["_file"], r["_block"], before - r["low"]))
        before += r["n"]
    starts = spark.createDataFrame(starts, "_file string, _block bigint, _shift bigint")
    return at.join(F.broadcast(starts), ["_file", "_block"]).withColumn(row_number, F.col("_at") + F.col("_shift")).select(*df.columns, row_number)


def select_traits(df: DataFrame, names: list[str], maximum: int | None = None) -> DataFrame:
    x = df.where(F.col("trait_name").isin(names))
    return x if maximum is None else x.orderBy("source_row_number").limit(maximum)


def trait_counts(df: DataFrame, names: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.count_if(F.coalesce(F.col("trait_name").isin(names), F.lit(False))).alias("selected"))


# Lines that open and close a collection around features of one line each; what else a line may hold makes its file one to parse whole.
_OPENING = r'(\{\s*)?("type"\s*:\s*"FeatureCollection"\s*,\s*)?"features"\s*:\s*\['
_AROUND = r'^(\{|\{?\s*"type"\s*:\s*"FeatureCollection"|"name"\s*:\s*"[^"\\]*"|\}|)$'


def read_features(spark: SparkSession, path: str, properties: str = "map<string,string>") -> DataFrame:
    """Rows (properties, geometry_type, coordinates as JSON) of feature collections.

    A file that has each feature on a line of its own, as ``write_features`` and most tools write them, is read by lines, and so by several
    tasks. Any other is parsed whole by one task, which must hold it.
    """
    columns = f"properties {properties}, geometry struct<type:string,coordinates:string>"
    text = F.regexp_replace(F.trim(F.regexp_replace("value", r"\s+$", "")), r"\s*,$", "")
    x = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), text.alias("_text"))
    alone = F.col("_text").rlike(r'^\{\s*"type"\s*:\s*"Feature"\s*,') & (F.json_array_length(F.concat(F.lit("["), "_text", F.lit("]"))) == 1)
    x = x.withColumn("_feature", F.coalesce(alone, F.lit(False)))
    opens, closes = F.col("_text").rlike(f"^{_OPENING}$"), F.col("_text").rlike(r"^\]\s*\}?$")
    odd = x.groupBy("_file").agg((F.every(F.col("_feature") | opens | closes | F.col("_text").rlike(_AROUND)) & (F.count_if(opens) == 1) & (F.count_if(closes) == 1)).alias("_ok")).where("not _ok")
    whole = [r["_file"] for r in odd.select("_file").collect()]  # names of files
    # The reader of lines keeps coordinates as they stand, and takes no notice of the comma after an object.
    rows = spark.read.schema(f"type string, {columns}").json(path).where((F.col("type") == "Feature") & ~F.col("_metadata.file_path").isin(whole)).drop("type")
    if whole:
        docs = spark.read.schema(f"features array<struct<{columns}>>").json(path, multiLine=True).where(F.col("_metadata.file_path").isin(whole))
        rows = rows.unionByName(docs.select(F.inline("features")))
    return rows.select("properties", F.col("geometry.type").alias("geometry_type"), F.col("geometry.coordinates").alias("coordinates"))


def resolve_cube(df: DataFrame) -> DataFrame:
    """An hourly table under its usual column names; a missing variable is null."""
    pick = lambda names: [F.col(f"`{n}`") for n in names if n in df.columns]
    return df.select(*((F.coalesce(*pick(names)) if pick(names) else F.lit(None).cast("double")).alias(k) for k, names in CUBE_NAMES.items()))


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if k in ("double", "float") else F.col(c) for c, k in df.dtypes))


def write_features(df: DataFrame, path: str, lon: str = "longitude", lat: str = "latitude") -> None:
    """Point features: each file of the folder is one feature collection, written line by line from its partition."""
    rest = [c for c in df.columns if c not in (lon, lat)]
    there = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    point = F.when(there, F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))
    kept = {"ignoreNullFields": "false"}
    features = df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*rest).alias("properties"), point.alias("geometry")), kept).alias("value"))

    def document(batches):
        import pyarrow as pa

        lines = lambda x: pa.RecordBatch.from_arrays([pa.array(x, pa.string())], names=["value"])
        yield lines(['{"type":"FeatureCollection","features":['])
        last = []  # waits to learn whether a comma ends it
        for batch in batches:
            said = last + batch.column(0).to_pylist()
            yield lines([v + "," for v in said[:-1]])
            last = said[-1:]
        yield lines([*last, "]}"])

    features.mapInArrow(document, "value string").write.mode("overwrite").text(path)


def write_vector(df: DataFrame, path: str) -> None:
    """Parquet, feature collections or JSON lines, by the path's ending."""
    if path.endswith(".geojson"):
        write_features(df, path)
    elif path.endswith((".json", ".jsonl")):
        df.write.mode("overwrite").json(path)
    elif path.endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unsupported vector format: {path}")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each file and, in every row, of all of them in name order."""
    x = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))
    # One name and digest for each file, not its content, comes together.
    parts = F.transform(F.array_sort(F.collect_list(F.struct("name", "sha256"))), lambda r: F.concat(r["name"], F.lit("\0"), r["sha256"], F.lit("\n")))
    return x.join(F.broadcast(x.agg(F.sha2(F.array_join(parts, ""), 256).alias("combined_sha256"))), F.lit(True))


# Keys that a registered source must have, and what its licence may be.
SOURCE_KEYS = ("key", "name", "publisher", "url", "category", "coverage", "licence", "licence_status")
LICENCE_STATUSES = ("open_confirmed", "public_domain", "review_required", "restricted")


def source_problems(registry: DataFrame) -> DataFrame:
    """What is wrong with a source registry (a row for each data set, a null where a key is absent): key, problem.

    An empty registry has the one problem ``no_datasets`` under a null key.
    """
    absent = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in SOURCE_KEYS)))
    x = registry.withColumn("_absent", absent)
    missing = x.where(F.size("_absent") > 0).select("key", F.concat(F.lit("missing:"), F.array_join("_absent", ",")).alias("problem"))
    twice = registry.where("key is not null").groupBy("key").count().where("count > 1").select("key", F.lit("duplicate_key").alias("problem"))
    odd = registry.where(~F.col("licence_status").isin(*LICENCE_STATUSES)).select("key", F.lit("unsupported_licence_status").alias("problem"))
    none = registry.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast(registry.schema["key"].dataType).alias("key"), F.lit("no_datasets").alias("problem"))
    return missing.unionByName(twice).unionByName(odd).unionByName(none)
