"""Council tree inventories and the other feeds, mapped to their shared contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlake.functions.text import clean, iso_date, numeric_range, positive_float, scientific_name, stable_id

# The contract of a named tree and its types.
CONTRACT = {
    "inventory_source_key": "string", "source_tree_id": "string", "municipality": "string", "longitude": "double", "latitude": "double", "active_record": "boolean",
    "common_name": "string", "scientific_name": "string", "display_name": "string", "genus": "string", "family": "string", "taxonomic_precision": "string",
    "diameter_breast_height_cm": "double", "dbh_min_cm": "double", "dbh_max_cm": "double", "height_m": "double", "height_min_m": "double", "height_max_m": "double",
    "canopy_width_m": "double", "canopy_width_min_m": "double", "canopy_width_max_m": "double", "canopy_width_ew_m": "double", "canopy_width_ns_m": "double",
    "year_planted": "int", "date_planted": "date", "age_description": "string", "useful_life_expectancy": "string", "health_status": "string", "structure_status": "string",
    "precinct": "string", "located_in": "string", "address": "string", "source_observed_on": "date",
}


def p(name: str) -> Column:
    return F.try_element_at("properties", F.lit(name))


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns as a generator's row: each is made once, however often it is named later."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


class Cleaned:
    """Cleaned properties by name; notes those that are asked for, so that each is projected once."""

    def __init__(self):
        self.asked: set[str] = set()

    def __call__(self, name: str) -> Column:
        self.asked.add(name)
        return F.col(f"`_{name}`")

    def number(self, name: str) -> Column:
        return positive_float(self(name), ready=True)

    def day(self, name: str) -> Column:
        return iso_date(self(name), ready=True)

    def joined(self, *names: str) -> Column:
        return F.nullif(F.concat_ws(" ", *map(self, names)), F.lit(""))

    def spread(self, name: str, low: str, high: str, scale: float = 1.0) -> dict[str, Column]:
        r = numeric_range(self(name), scale, ready=True)
        return {low: r["minimum"], high: r["maximum"]}

    def named(self, genus: str, species: str) -> dict[str, Column]:
        n = scientific_name(self(genus), self(species), ready=True)
        return {"scientific_name": n["name"], "taxonomic_precision": n["precision"], "genus": self(genus)}

    def keyed(self, source: str, *ids: str, otherwise: tuple = ()) -> Column:
        """``source:id`` by the first id there is, else a digest of the rest."""
        other = stable_id(source, "longitude", "latitude", *otherwise)
        return F.coalesce(F.concat(F.lit(f"{source}:"), F.coalesce(*map(self, ids))), other) if ids else other


def _labelled(botanical: Column, common: Column | None = None, precision: Column | None = None) -> dict[str, Column]:
    """Names where the source gives a full botanical label."""
    known = F.when(botanical.isNotNull(), "species") if precision is None else precision
    return {"scientific_name": botanical, "genus": F.split(botanical, " ")[0], "taxonomic_precision": known if common is None else F.coalesce(known, F.when(common.isNotNull(), "common_name"))}


def _brimbank(c: Cleaned):
    n = c.named("Genus", "Species")
    return n | c.spread("height", "height_min_m", "height_max_m") | c.spread("canopy", "canopy_width_min_m", "canopy_width_max_m") | c.spread("dbh", "dbh_min_cm", "dbh_max_cm") | {
        "source_tree_id": c.keyed("brimbank", otherwise=(p("Location"), n["scientific_name"])), "located_in": c("Type"), "address": c("Location"),
        "active_record": F.coalesce(F.lower(c("Status")) == "existing", F.lit(False)),
    }


def _yarra(c: Cleaned):
    n, common = c.named("genus", "species"), c("common")
    return n | {
        "source_tree_id": c.keyed("yarra", "ref", otherwise=(common, n["scientific_name"])), "common_name": common, "family": c("family"),
        "taxonomic_precision": F.coalesce(n["taxonomic_precision"], F.when(common.isNotNull(), "common_name")), "diameter_breast_height_cm": c.number("dbh"), "height_m": c.number("height"),
        "age_description": c("maturity"), "useful_life_expectancy": c("ule_min, ule_max"), "health_status": c("health"), "structure_status": c("structure"),
        "located_in": c("location"), "address": c("address"), "source_observed_on": c.day("updated"),
    }


def _casey(c: Cleaned):
    common, full, told = c("commonname"), c("botanicname"), c("description")
    family = scientific_name(c("familygenus"), F.lit(None).cast("string"), ready=True)
    genus, rest = F.regexp_extract(told, r"^([A-Z][A-Za-z.-]+)\s+(.+)$", 1), F.lower(F.regexp_extract(told, r"^([A-Z][A-Za-z.-]+)\s+(.+)$", 2))
    bare = rest.isin("species", "sp", "sp.")
    from_text = F.when(genus != "", F.when(bare, F.concat(genus, F.lit(" sp."))).otherwise(told))
    botanical = F.coalesce(full, family["name"], from_text)
    precision = F.when(full.isNotNull(), "species").when(family["name"].isNotNull(), family["precision"]).when(from_text.isNotNull(), F.when(bare, "genus").otherwise("species"))
    ew, ns = c.number("canopyewwidth_m"), c.number("canopynswidth_m")
    return _labelled(botanical, common, precision) | {
        "source_tree_id": c.keyed("casey", "assetnumber", "legacyassetnumber", otherwise=(common, botanical)), "common_name": common, "family": c("details"),
        "diameter_breast_height_cm": c.number("diameterbreast_hcm"), "height_m": c.number("treeheight_m"), "canopy_width_m": F.coalesce(F.round((ew + ns) / 2, 4), ew, ns),
        "canopy_width_ew_m": ew, "canopy_width_ns_m": ns, "age_description": c("treeage"), "useful_life_expectancy": c("expectedusefullife"), "health_status": c("treehealth"),
        "structure_status": c("treestructure"), "precinct": c("ward"), "located_in": c("treetype"), "address": c.joined("address", "suburb", "postcode"), "date_planted": c.day("acquisitiondate"),
    }


def _hobsons_bay(c: Cleaned):
    n = c.named("Genus", "Species")
    return n | c.spread("dbh_mm", "dbh_min_cm", "dbh_max_cm", 0.1) | {
        "source_tree_id": c.keyed("hobsons_bay", otherwise=(p("type"), n["scientific_name"])), "precinct": c("ward_name"), "located_in": c("type"), "address": c("suburb"),
    }


def _wyndham(c: Cleaned):
    common = c("tree_common")
    return {
        "source_tree_id": c.keyed("wyndham", "tree_id", otherwise=(common,)), "common_name": common, "taxonomic_precision": F.when(common.isNotNull(), "common_name"), "diameter_breast_height_cm": c.number("diameter_breast_height"),
        "height_m": c.number("height"), "canopy_width_m": c.number("canopy_width"), "age_description": c("tree_age"), "useful_life_expectancy": c("useful_life_expectancy"),
        "health_status": c("health"), "structure_status": c("structure"), "source_observed_on": c.day("inspection_date"),
    }


def _port_phillip(c: Cleaned):
    common, botanical, planted = c("common"), c("species"), c.day("planted")
    return _labelled(botanical, common) | {
        "source_tree_id": c.keyed("port_phillip", "ref", otherwise=(common, botanical)), "common_name": common, "diameter_breast_height_cm": c.number("dbh"), "height_m": c.number("height"),
        "canopy_width_m": c.number("crown"), "canopy_width_min_m": c.number("crown_min"), "canopy_width_max_m": c.number("crown_max"), "year_planted": F.year(planted), "date_planted": planted,
        "located_in": c("location"), "source_observed_on": c.day("updated"),
    }


def _manningham(c: Cleaned):
    botanical, address = c("species"), c.joined("house", "street", "str_type", "suburb", "pcode")
    return _labelled(botanical) | c.spread("height", "height_min_m", "height_max_m") | c.spread("dbh", "dbh_min_cm", "dbh_max_cm", 0.1) | {
        "source_tree_id": c.keyed("manningham", otherwise=(botanical, address)), "precinct": c("treearea"), "located_in": F.lit("street"), "address": address, "source_observed_on": c.day("date1"),
    }


def _glen_eira(c: Cleaned):
    common, botanical = c("Common_Name"), c("Botanical")
    return _labelled(botanical, common) | {
        "source_tree_id": c.keyed("glen_eira", "feature_id", otherwise=(common, botanical)), "common_name": common, "diameter_breast_height_cm": c.number("DBH"), "height_m": c.number("Height"),
        "canopy_width_m": c.number("Spread"), "located_in": c("LocationType"),
    }


COUNCILS = {
    "brimbank": ("City of Brimbank", _brimbank), "yarra": ("City of Yarra", _yarra), "casey": ("City of Casey", _casey), "hobsons_bay": ("City of Hobsons Bay", _hobsons_bay),
    "wyndham": ("City of Wyndham", _wyndham), "port_phillip": ("City of Port Phillip", _port_phillip), "manningham": ("City of Manningham", _manningham), "glen_eira": ("City of Glen Eira", _glen_eira),
}


def normalise_council(features: DataFrame, source: str) -> DataFrame:
    """Features (properties map, longitude, latitude) of one council as rows of the tree contract."""
    if source not in COUNCILS:
        raise ValueError(f"Unsupported council tree source: {source}")
    municipality, columns = COUNCILS[source]
    c = Cleaned()
    named = columns(c)
    own = {"inventory_source_key": F.lit(source), "municipality": F.lit(municipality), "longitude": F.col("longitude"), "latitude": F.col("latitude"), "active_record": F.lit(True)} | named
    own.setdefault("display_name", F.coalesce(*(own[c] for c in ("common_name", "scientific_name") if c in own)))
    # As a generator's row, of which no filter or column takes the making along: each text is looked up and cleaned once.
    texts = F.get(F.transform(F.array("properties"), lambda m: F.struct(*(clean(F.try_element_at(m, F.lit(n))).alias(f"_{n}") for n in sorted(c.asked)))), F.lit(0))
    features = features.select("longitude", "latitude", "properties", F.inline_outer(F.array(texts)))
    return features.select(*((own[n] if n in own else F.lit(None)).cast(k).alias(n) for n, k in CONTRACT.items()))


def normalise_councils(feeds: dict[str, DataFrame]) -> DataFrame:
    """All councils' active, named trees."""
    rows = reduce(DataFrame.unionByName, (normalise_council(df, k) for k, df in sorted(feeds.items())))
    return rows.where("active_record and display_name is not null")


def normalise_weather(rows: DataFrame) -> DataFrame:
    """Station rows as observations: empty and dash are null, km/h become m/s, Trace is no rain, times are UTC."""
    v = lambda c: F.when(~F.trim(c).isin("", "-"), F.trim(c))
    num = lambda c: v(c).try_cast("double")
    rain = F.when(F.lower(v("rain_trace")) == "trace", 0.0).otherwise(num("rain_trace"))
    when = F.coalesce(F.try_to_timestamp("aifstime_utc", F.lit("yyyyMMddHHmmss")), v("aifstime_utc").try_cast("timestamp"))
    place = F.format_string("POINT (%s %s)", num("lon").cast("string"), num("lat").cast("string"))
    return rows.select(
        F.coalesce(v("wmo"), v("history_product")).alias("station_code"), v("name").alias("station_name"), when.alias("observed_at"), num("air_temp").alias("air_temperature_c"), num("apparent_t").alias("apparent_temperature_c"),
        num("rel_hum").alias("humidity_pct"), F.round(num("wind_spd_kmh") / 3.6, 3).alias("wind_speed_ms"), rain.alias("rainfall_since_9am_mm"), F.when(num("lon").isNotNull() & num("lat").isNotNull(), place).alias("geometry_wkt"),
    )


def registry_problems(registry: DataFrame, roles: list[str], prefix: str) -> DataFrame:
    """What is wrong with a station registry: missing keys, repeated codes, roles without a station, foreign addresses."""
    said = lambda df, text: df.select(F.col("station_code").cast("string").alias("subject"), F.lit(text).alias("problem"))
    missing = said(registry.where("station_code is null or name is null or url is null or role is null"), "missing key")
    twice = said(registry.groupBy("station_code").count().where("count > 1"), "repeated code")
    foreign = said(registry.where(~F.startswith("url", F.lit(prefix))), "unofficial address")
    wanted = registry.sparkSession.createDataFrame([(r,) for r in roles], "role string")
    absent = wanted.join(registry, "role", "left_anti").select(F.col("role").alias("subject"), F.lit("role without a station").alias("problem"))
    return missing.unionByName(twice).unionByName(foreign).unionByName(absent)


def feed_coverage(registry: DataFrame, feeds: DataFrame, least: float = 80.0) -> DataFrame:
    """Share of registered stations whose feed holds their own code and no other, and whether that is enough."""
    codes = feeds.groupBy(F.col("requested_code").alias("station_code")).agg(F.sort_array(F.collect_set("station_code")).alias("codes"))
    x = registry.select("station_code").join(codes, "station_code", "left")
    ok = F.coalesce(F.col("codes") == F.array("station_code"), F.lit(False))
    share = F.count_if(ok) / F.count("*") * 100
    return x.agg(F.count("*").alias("requested"), F.count_if(ok).alias("succeeded"), F.round(share, 2).alias("coverage_pct"), (share >= least).alias("publish"))


def normalise_urban_tree(features: DataFrame) -> DataFrame:
    """Urban tree points once by object id; implausible radius and height become null and the row stays."""
    keep = lambda c, lo, hi: F.when(number(c).between(lo, hi), number(c))
    number = lambda c: p(c).try_cast("double")
    x = features.select(
        F.nullif(F.trim(p("OBJECTID")), F.lit("")).alias("source_tree_id"), keep("canopy_radius", 0.25, 50).alias("canopy_radius_m"), keep("tree_height", 0.5, 100).alias("height_m"), "longitude", "latitude"
    )
    return x.dropDuplicates(["source_tree_id"])


def slug_keys(properties: Column) -> Column:
    """A property map with lower-case keys in which anything else than letters and digits is one underscore."""
    return F.transform_keys(properties, lambda k, _: F.regexp_replace(F.lower(F.trim(k)), "[^a-z0-9]+", "_"))


def first_of(properties: Column, *names: str) -> Column:
    return F.coalesce(*(F.nullif(F.trim(F.try_element_at(properties, F.lit(n))), F.lit("")) for n in names))


def normalise_change(features: DataFrame, measures: dict[str, tuple[str, ...]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Vegetation-change features: measures by any of their names, a key or a digest of the geometry, all properties as JSON, and the columns to ``keep``."""
    x = bound(features, _p=slug_keys(F.col("properties")))
    x = bound(x, _key=F.coalesce(F.concat(F.lit("mmb:"), first_of(F.col("_p"), "unique_id", "mmb_unique")), F.concat(F.lit("geometry:"), F.sha2("geometry", 256))))
    got = {k: first_of(F.col("_p"), *names).try_cast("double") for k, names in measures.items()}
    return x.select(F.col("_key").alias("source_feature_key"), *(c.alias(k) for k, c in got.items()), F.coalesce(*got.values()).isNotNull().alias("has_change_measure"), F.to_json("properties").alias("source_properties"), *keep)


def normalise_guidance(rows: DataFrame, lga: DataFrame, statuses: list[str], sizes: list[str]) -> DataFrame:
    """Guidance rows with the reasons that reject them; an empty list is a good row."""
    known = lga.select("lga_code", F.lit(True).alias("_known"))
    x = rows.join(known, "lga_code", "left")
    pos = [F.when(F.col(c) <= 0, F.lit(f"{c} must be positive")) for c in ("mature_height_m", "mature_canopy_m") if c in rows.columns]
    why = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("guidance_status").isin(statuses), F.lit(False)), F.lit("unknown status")), F.when(~F.coalesce(F.col("mature_size_class").isin(sizes), F.lit(False)), F.lit("unknown size")),
        F.when(clean("scientific_name").isNull() & clean("common_name").isNull(), F.lit("a name is required")), F.when(F.col("effective_to") < F.col("effective_from"), F.lit("dates out of order")),
        F.when(F.col("_known").isNull(), F.lit("unknown council code")), *pos,
    ))
    return x.withColumn("reject_reasons", why).drop("_known")


def guidance_file_problems(rows: DataFrame, licences: list[str]) -> DataFrame:
    """What is wrong with each guidance file (column file): more than one source in it, or a licence status that is not allowed."""
    x = rows.groupBy("file").agg(F.count_distinct("source_name").alias("_sources"), F.every(F.coalesce(F.col("licence_status").isin(licences), F.lit(False))).alias("_allowed"))
    said = F.array_compact(F.array(F.when(F.col("_sources") != 1, F.lit("not_one_source")), F.when(~F.col("_allowed"), F.lit("licence_not_allowed"))))
    return x.select("file", F.explode(said).alias("problem"))


def normalise_costs(rows: DataFrame) -> DataFrame:
    """Cost rows from text: blanks are null, money is decimal, flags are boolean, days are dates."""
    money, days, flags = ("minimum_cost", "maximum_cost"), ("valid_from", "valid_to", "last_verified_at"), ("includes_installation",)
    blank_null = lambda c: F.nullif(F.trim(c), F.lit(""))
    kind = lambda c: "decimal(12,2)" if c in money else "date" if c in days else "boolean" if c in flags else "string"
    return rows.select(*(blank_null(c).try_cast(kind(c)).alias(c) for c in rows.columns))


# Corrected species labels of the ring-width table.
CORRECTIONS = {"Robinia pseudoacia": "Robinia pseudoacacia", "Ulmus parvifolia.": "Ulmus parvifolia"}


def normalise_rings(rows: DataFrame) -> DataFrame:
    """Tree-ring rows with corrected species and a running number within each tree."""
    from greenlake.operators.grid import ring_sequence

    fixed = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for c in CORRECTIONS.items() for x in c)), F.trim("Species")), F.trim("Species"))
    x = rows.select(
        "source_row_number", F.trim("City").alias("city"), F.trim("Species").alias("species_name_original"), fixed.alias("species_name"), F.col("Ttree").cast("string").try_cast("int").alias("tree_number"),
        F.col("TRW").cast("string").try_cast("double").alias("tree_ring_width_mm"), F.col("BAI").cast("string").try_cast("double").alias("basal_area_increment_cm2_year"),
    )
    return ring_sequence(x)


def tiles_of(spark, xmin: float, ymin: float, xmax: float, ymax: float, size: float) -> DataFrame:
    """Square tiles over a bounding box, the last ones cut to it."""
    import math

    nx, ny = max(1, math.ceil((xmax - xmin) / size)), max(1, math.ceil((ymax - ymin) / size))
    x = spark.range(nx * ny).select((F.col("id") % nx).alias("i"), F.floor(F.col("id") / nx).alias("j"))
    lo, hi = lambda k, o: F.lit(o) + F.col(k) * size, lambda k, o, m: F.least(F.lit(o) + (F.col(k) + 1) * size, F.lit(m))
    return x.select(lo("i", xmin).alias("xmin"), lo("j", ymin).alias("ymin"), hi("i", xmin, xmax).alias("xmax"), hi("j", ymin, ymax).alias("ymax"))


def split_tiles(tiles: DataFrame) -> DataFrame:
    """Each tile in four."""
    mx, my = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    box = lambda a, b, c, d: F.struct(a.alias("xmin"), b.alias("ymin"), c.alias("xmax"), d.alias("ymax"))
    lo_x, lo_y, hi_x, hi_y = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    return tiles.select(F.inline(F.array(box(lo_x, lo_y, mx, my), box(mx, lo_y, hi_x, my), box(lo_x, my, mx, hi_y), box(mx, my, hi_x, hi_y))))


def _text(name: str) -> Column:
    return F.nullif(F.trim(p(name)), F.lit(""))


def normalise_melbourne_trees(features: DataFrame) -> DataFrame:
    """The central city's own tree extract as rows of the tree contract, with its useful life in years."""
    names = ("com_id", "longitude", "latitude", "common_name", "scientific_name", "genus", "family", "diameter_breast_height", "year_planted", "age_description", "useful_life_expectency", "useful_life_expectency_value", "precinct", "located_in", "date_planted")
    # One small loop for all names: an expression for each would be too long a method to be compiled.
    texts = bound(features, _t=F.transform(F.array(*map(F.lit, names)), lambda n: clean(F.try_element_at("properties", n))))
    text = lambda n: F.get("_t", F.lit(names.index(n)))
    num = lambda n, k="double": text(n).try_cast(k)
    own = {
        "inventory_source_key": F.lit("melbourne"), "municipality": F.lit("City of Melbourne"), "source_tree_id": text("com_id"), "longitude": num("longitude"), "latitude": num("latitude"), "active_record": F.lit(True),
        "common_name": text("common_name"), "scientific_name": text("scientific_name"), "display_name": F.coalesce(text("common_name"), text("scientific_name")), "genus": text("genus"), "family": text("family"), "diameter_breast_height_cm": num("diameter_breast_height"),
        "year_planted": num("year_planted", "int"), "date_planted": iso_date(text("date_planted"), ready=True), "age_description": text("age_description"), "useful_life_expectancy": text("useful_life_expectency"),
        "precinct": text("precinct"), "located_in": text("located_in"),
    }
    x = texts.select(*((own[c] if c in own else F.lit(None)).cast(k).alias(c) for c, k in CONTRACT.items()), num("useful_life_expectency_value", "int").alias("useful_life_expectancy_years"))
    return x


def normalise_address(features: DataFrame) -> DataFrame:
    """Address points: texts trimmed, blanks null, the place as WKT."""
    names = {"source_address_id": "pfi", "source_property_id": "property_pfi", "full_address": "ezi_address", **{n: n for n in ("locality_name", "postcode", "lga_code", "is_primary", "address_class")}}
    place = F.when(F.col("longitude").isNotNull() & F.col("latitude").isNotNull(), F.format_string("POINT (%s %s)", F.col("longitude").cast("string"), F.col("latitude").cast("string")))
    return features.select(*(_text(v).alias(k) for k, v in names.items()), place.alias("geometry_wkt"))


def normalise_parcel(features: DataFrame) -> DataFrame:
    names = {"source_parcel_id": "prop_pfi", "property_number": "prop_propnum", "property_type": "prop_property_type", "property_status": "prop_status", "lga_code": "prop_lga_code"}
    return features.select(*(_text(v).alias(k) for k, v in names.items()), _text("Shape__Area").try_cast("double").alias("parcel_area_m2"), F.col("geometry").alias("geometry_wkt"))


def normalise_lga(features: DataFrame) -> DataFrame:
    """Council areas, their properties looked up whatever the case of their names."""
    features = bound(features, _low=F.transform_keys("properties", lambda k, _: F.lower(k)))
    got = {n: first_of(F.col("_low"), n) for n in ("lga_code", "lga_name", "lga_official_name", "abs_lga_code", "gazettal_registration", "ufi")}
    return features.select(
        F.coalesce(got["ufi"], got["lga_code"]).alias("source_feature_id"), got["lga_code"].alias("lga_code"), got["lga_name"].alias("lga_name"), F.coalesce(got["lga_official_name"], got["lga_name"]).alias("lga_official_name"),
        got["abs_lga_code"].alias("abs_lga_code"), got["gazettal_registration"].alias("gazettal_registration"), F.col("geometry").alias("geometry_wkt"),
    )


def normalise_canopy_snapshot(features: DataFrame, year: int) -> DataFrame:
    """Canopy polygons of one snapshot: a key from the geometry, the source's area, and how far it is off the measured one.

    ``features`` has properties, geometry (text) and measured_m2.
    """
    source = F.coalesce(*(_text(n).try_cast("double") for n in ("area", "shape_area", "shape__area")))
    return features.select(
        F.sha2("geometry", 256).alias("source_feature_key"), F.lit(year).alias("observed_year"), F.lit(f"{year}-12-31").cast("date").alias("observed_on"), F.col("geometry").alias("geometry_wkt"),
        F.col("measured_m2").alias("calculated_area_m2"), source.alias("source_area_m2"), F.when(F.col("measured_m2") > 0, F.abs(source - F.col("measured_m2")) / F.col("measured_m2") * 100).alias("source_area_difference_pct"),
    )


def normalise_traits(rows: DataFrame) -> DataFrame:
    """Trait rows with texts trimmed, blanks null, and the value also as a number."""
    texts = [c for c, k in rows.dtypes if k == "string"]
    x = rows.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in texts if c not in ("value", "trait_name")})
    n = F.trim("value").try_cast("double")
    return x.withColumns({"value_text": F.trim("value"), "value_numeric": F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n), "trait_name": F.trim("trait_name")})


# Licence addresses that an image may carry, and their names.
LICENCES = {
    "https://creativecommons.org/publicdomain/zero/1.0": "CC0 1.0", "https://creativecommons.org/licenses/by/4.0": "CC BY 4.0", "https://creativecommons.org/licenses/by-sa/4.0": "CC BY-SA 4.0",
    "https://creativecommons.org/licenses/by/3.0": "CC BY 3.0", "https://creativecommons.org/licenses/by-sa/3.0": "CC BY-SA 3.0",
}


def licence_name(address) -> Column:
    """The name of an approved licence by its address, or null."""
    a = F.regexp_replace(F.regexp_replace(F.lower(F.trim(address)), "^http://", "https://"), "(/legalcode|/deed[^/]*)?/*$", "")
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in LICENCES.items() for x in pair)), a)


def asset_source(role) -> tuple[Column, Column]:
    """Source type of a canopy asset's role, and whether it only stands in for analytical data."""
    r = F.col(role) if isinstance(role, str) else role
    proxy = r == "canopy_api_tile_mosaic"
    analytical = r.isin("canopy_source_raster", "canopy_analytical_geotiff")
    kind = F.when(proxy, "api_tile_proxy").when(analytical, "analytical_geotiff").otherwise(F.raise_error(F.concat(F.lit("unsupported canopy asset role: "), r)))
    return kind, proxy
