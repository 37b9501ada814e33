"""Address search and property answers, for many requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenlake.functions import classify
from greenlake.functions.text import normalize_address, prefix_candidates
from greenlake.operators.spatial_join import BUCKET, count_in_areas

PREFIX = 6


#: Requests up to this many go to every task; a request and its forms take some hundred bytes.
MOST_REQUESTS = 50_000


def address_matches(requests: DataFrame, addresses: DataFrame, typed: bool = False, most_requests: int = MOST_REQUESTS) -> DataFrame:
    """Pairs of requests and addresses whose upper-cased text starts with the request's, and whether they are equal.

    Requests are normalised, or with ``typed`` tried as typed and with street types spelled out. The join is
    an equi-join on the first PREFIX characters, or on all of a shorter form. Requests are broadcast up to
    ``most_requests``; addresses are then not shuffled. They are keyed by the lengths that requests have, and a
    pair is found by the shortest of its forms alone.
    """
    forms = prefix_candidates(F.col("request")) if typed else F.array(normalize_address("request"))
    r = requests.select("request_id", "request", F.filter(forms, lambda f: f != "").alias("_forms"))
    reach = lambda f: F.least(F.length(f), F.lit(PREFIX))
    keys = F.array_distinct(F.transform("_forms", lambda f: F.struct(reach(f).alias("n"), F.substring(f, 1, PREFIX).alias("p"))))
    r = r.withColumn("_k", F.explode(keys)).select("request_id", "request", "_forms", F.col("_k.n").alias("_n"), F.col("_k.p").alias("_p"))
    lengths = sorted(row[0] for row in r.select("_n").distinct().collect())  # at most PREFIX
    if r.limit(most_requests + 1).count() <= most_requests:
        r = F.broadcast(r)
    a = addresses.withColumn("_text", F.upper("full_address"))
    a = a.withColumn("_n", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"))).where(F.length("_text") >= F.col("_n"))
    x = a.withColumn("_p", F.substring(F.col("_text"), F.lit(1), F.col("_n"))).join(r, ["_n", "_p"])
    meets = F.filter("_forms", lambda f: F.startswith(F.col("_text"), f))
    x = x.where((F.size(meets) > 0) & (F.array_min(F.transform(meets, reach)) == F.col("_n")))
    return x.withColumn("exact", F.array_contains("_forms", F.col("_text"))).drop("_n", "_p", "_text", "_forms")


def _texts(requests: DataFrame) -> DataFrame:
    """Each request's text once, under itself as id: what is asked alike is answered once."""
    return requests.select("request").distinct().withColumn("request_id", F.col("request"))


def autocomplete(requests: DataFrame, addresses: DataFrame, limit: int = 10) -> DataFrame:
    """The first matches of each typed prefix: exact, then primary, then by text; limit within 1 and 50."""
    limit = min(max(limit or 10, 1), 50)
    w = Window.partitionBy("request").orderBy(F.desc("exact"), F.desc(F.coalesce(F.col("is_primary") == "Y", F.lit(False))), "full_address", "address_id")
    first = address_matches(_texts(requests), addresses, typed=True).drop("request_id").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    return requests.select("request_id", "request").join(first, "request")


def grouped_addresses(addresses: DataFrame) -> DataFrame:
    """One row for each normalised address and parcel text: its first id, all ids, and how many."""
    x = addresses.select(normalize_address("full_address").alias("address"), "address_id", "parcel_id")
    return x.groupBy("address").agg(
        F.min("address_id").alias("address_id"), F.min_by("parcel_id", "address_id").alias("parcel_id"),
        F.sort_array(F.collect_set("address_id")).alias("address_ids"), F.count_distinct("address_id").alias("n_addresses"),
    )


def resolve(requests: DataFrame, addresses: DataFrame) -> DataFrame:
    """The address of each request, or why there is none: no match, ambiguous, or without a place."""
    x = address_matches(_texts(requests), addresses)
    order = F.struct((~F.col("exact")).cast("int"), "full_address", "address_id")
    best = x.groupBy("request").agg(F.min_by(F.struct("address_id", "full_address", "parcel_id", "x", "y"), order).alias("a"), F.count("*").alias("n_matches"), F.count_if("exact").alias("n_exact"))
    x = requests.select("request_id", "request").join(best, "request", "left")
    status = (
        F.when(F.coalesce("n_matches", F.lit(0)) == 0, "no_match").when((F.col("n_exact") == 0) & (F.col("n_matches") > 1), "ambiguous")
        .when(F.col("a.x").isNull() | F.col("a.y").isNull(), "no_coordinate").otherwise("resolved")
    )
    ok = lambda c: F.when(status == "resolved", F.col(f"a.{c}")).alias(c)
    return x.select("request_id", "request", status.alias("status"), F.coalesce("n_matches", F.lit(0)).alias("n_matches"), ok("address_id"), ok("full_address"), ok("parcel_id"), ok("x"), ok("y"))


def with_parcels(addresses: DataFrame, parcels: DataFrame) -> DataFrame:
    """Addresses with their parcel's columns by source key; unmatched ones stay."""
    return addresses.join(parcels, addresses["source_property_id"] == parcels["source_parcel_id"], "left")


def cell_lookup(points: DataFrame, cells: DataFrame, value: str, size: float, name: str) -> DataFrame:
    """Points with the value of the grid cell that holds them, the newest day and then the greatest id."""
    c = cells.groupBy("cell_x", "cell_y").agg(F.max_by(value, F.struct("observed_on", "cell_id")).alias(name))
    p = points.withColumns({"cell_x": F.floor(F.col("x") / size), "cell_y": F.floor(F.col("y") / size)})
    return p.join(c, ["cell_x", "cell_y"], "left").drop("cell_x", "cell_y")


def limitations(**parts: Column) -> Column:
    """A JSON object of the limitations that apply."""
    m = F.map_filter(F.create_map(*(x for k, v in sorted(parts.items()) for x in (F.lit(k), v))), lambda _, v: v.isNotNull())
    return F.to_json(m)


def merged_limitations(*parts: Column | str) -> Column:
    """One JSON object of several; a later part's entry replaces an earlier one's."""
    maps = [F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>")) for c in parts]
    entries = F.flatten(F.array(*(F.map_entries(m) for m in maps)))
    names = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["key"])))
    last = lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]
    return F.to_json(F.map_from_arrays(names, F.transform(names, last)))


def baseline(properties: DataFrame, heat: DataFrame, canopy: DataFrame, trees: DataFrame | None, weather: DataFrame | None, size: float = 500.0) -> DataFrame:
    """Heat, canopy, tree count, nearest weather and classes of every property, with the limits of each.

    ``properties`` has parcel_id, x, y, the box and area_m2. Cells are met by their key, trees by grid
    buckets, and weather by :func:`greenlake.operators.weather.nearest_recent`. Without a tree table the count is
    null; with one, a parcel without trees has 0.
    """
    x = cell_lookup(properties, heat, "heat_value", size, "heat_value")
    x = cell_lookup(x, canopy, "canopy_pct", size, "canopy_pct")
    if trees is not None:
        n = count_in_areas(properties.select("parcel_id", "xmin", "ymin", "xmax", "ymax"), trees, "parcel_id", "n_trees", BUCKET).select("parcel_id", "n_trees")
        x = x.join(n, "parcel_id", "left")
    else:
        x = x.withColumn("n_trees", F.lit(None).cast("bigint"))
    if weather is not None:
        x = x.join(weather, "parcel_id", "left")
    return x.withColumns({
        "lot_size": classify.lot_size("area_m2"), "heat_class": classify.temperature_band("heat_value"), "canopy_class": classify.canopy_band("canopy_pct"),
        "limitations": limitations(
            heat=F.when(F.col("heat_value").isNull(), F.lit("no heat cell covers the property")),
            canopy=F.when(F.col("canopy_pct").isNull(), F.lit("no canopy cell covers the property; this is not zero canopy")),
            trees=F.when(F.col("n_trees").isNull(), F.lit("no tree inventory is loaded")),
        ),
    })


def property_canopy(properties: DataFrame, parcel_canopy: DataFrame) -> DataFrame:
    """Parcel canopy laid over the neighbourhood's: its scope, value and class; what is missing is Unavailable, not 0."""
    c = parcel_canopy.select("parcel_id", F.col("canopy_pct").alias("parcel_canopy_pct"), F.col("status").alias("parcel_status"))
    x = properties.join(c, "parcel_id", "left")
    own = F.col("parcel_status").eqNullSafe("passed") & F.col("parcel_canopy_pct").isNotNull()
    return x.withColumns({
        "canopy_scope": F.when(own, "property").otherwise("neighbourhood"), "property_canopy_pct": F.when(own, F.col("parcel_canopy_pct")),
        "property_canopy_class": classify.canopy_band(F.when(own, F.col("parcel_canopy_pct"))),
        "canopy_status": F.when(own, "available").when(F.col("parcel_status").isNull(), "not_assessed").otherwise("assessment_failed"),
    })


def property_category(properties: DataFrame, assignments: DataFrame, categories: DataFrame, as_of: Column) -> DataFrame:
    """Each property's primary category in force on a day, the surest and newest, or ``unclassified``."""
    a = assignments.join(categories.where("active").select("category_code"), "category_code", "left_semi")
    a = a.where("active and is_primary").where((F.col("valid_from").isNull() | (F.col("valid_from") <= as_of)) & (F.col("valid_to").isNull() | (F.col("valid_to") >= as_of)))
    best = a.groupBy("parcel_id").agg(F.max_by("category_code", F.struct(F.coalesce("confidence", F.lit(-1.0)), "updated_at", -F.col("assignment_id"))).alias("category_code"))
    x = properties.join(best, "parcel_id", "left")
    return x.withColumns({"category_status": F.when(F.col("category_code").isNull(), "unclassified_source_not_loaded").otherwise("source_backed_category"), "category_code": F.coalesce("category_code", F.lit("unclassified"))})


def code_label(column, labels: dict[str, str]) -> Column:
    """A code's label, or null for a code that has none."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in labels.items() for x in pair)), F.col(column))


def _within(centres: DataFrame, boundary: DataFrame | None) -> DataFrame:
    """The centres (cx, cy) that a boundary of boxes holds, or all without one."""
    from greenlake.operators.spatial_join import points_in_areas

    if boundary is None:
        return centres
    inside = points_in_areas(centres.withColumns({"x": F.col("cx"), "y": F.col("cy")}), boundary.select("xmin", "ymin", "xmax", "ymax"), "left_semi")
    return inside.select(*centres.columns)


def environment_context(centres: DataFrame, layers: dict[str, DataFrame], radius: float, limit: int, boundary: DataFrame | None = None) -> DataFrame:
    """The nearest ``limit`` things of each layer around each centre: (centre_id, layer, id, distance_m, rank).

    ``layers`` maps a name to a table of id with x, y, or with a box. Radius is within 0 and 2000, the limit
    within 1 and 2000. With a ``boundary`` of boxes, centres outside it have no rows. Centres of one place are
    answered once, and of things in one place only the first ``limit`` by id can be in an answer.
    """
    from greenlake.operators.spatial_join import near_pairs, top_k

    centres = _within(centres, boundary)
    if not 0 < radius <= 2000 or not 1 <= limit <= 2000:
        raise ValueError("radius must be within 0 and 2000 metres and limit within 1 and 2000")
    spots = centres.select("cx", "cy").distinct().select(F.struct("cx", "cy").alias("centre_id"), "cx", "cy")
    out = None
    for name, df in layers.items():
        place = ["xmin", "ymin", "xmax", "ymax"] if "xmin" in df.columns else ["x", "y"]
        first = top_k(df.select(F.col("id").cast("string").alias("id"), *place), place, limit, "id").drop("rank")
        x = near_pairs(spots, first, float(radius), limit).select("centre_id", F.lit(name).alias("layer"), "id", "distance_m")
        out = x if out is None else out.unionByName(x)
    best = top_k(out, ["centre_id", "layer"], limit, "distance_m", "id").select("centre_id.*", "layer", "id", "distance_m", "rank")
    return centres.select("centre_id", "cx", "cy").join(best, ["cx", "cy"]).drop("cx", "cy")


def environment_counts(centres: DataFrame, layers: dict[str, DataFrame], radius: float, boundary: DataFrame | None = None) -> DataFrame:
    """How many things of each layer are around each centre, all of them: (centre_id, layer, n), without rows for none.

    Takes what :func:`environment_context` takes, but has no limit. Places of centres meet places of things, which count for all
    that share them; what meets is counted where it meets, so pairs are not shuffled.
    """
    from greenlake.operators.spatial_join import boxes_within_radius, within_radius

    if not 0 < radius <= 2000:
        raise ValueError("radius must be within 0 and 2000 metres")
    number = lambda *names: [F.col(c).cast("double").alias(c) for c in names]
    spots = _within(centres.select(*number("cx", "cy")).distinct(), boundary)
    out = None
    for name, df in layers.items():
        met, place = (boxes_within_radius, ["xmin", "ymin", "xmax", "ymax"]) if "xmin" in df.columns else (within_radius, ["x", "y"])
        # Both sides grow with the input, so neither is to be broadcast.
        places = df.select(*number(*place)).groupBy(*place).agg(F.count("*").alias("n")).hint("merge")
        x = met(spots, places, float(radius)).groupBy("cx", "cy").agg(F.sum("n").alias("n")).withColumn("layer", F.lit(name))
        out = x if out is None else out.unionByName(x)
    return centres.select("centre_id", *number("cx", "cy")).join(out.hint("merge"), ["cx", "cy"]).select("centre_id", "layer", "n")


def named_trees_near(centres: DataFrame, trees: DataFrame, radius: float = 100.0, limit: int = 100) -> DataFrame:
    """The nearest named trees (id, x, y and what else they have) of each centre, by distance and then id, with a rank and what is known of such lists."""
    near = environment_context(centres, {"trees": trees.select("id", "x", "y")}, radius, limit)
    x = near.select("centre_id", F.col("id").alias("_id"), F.round("distance_m", 2).alias("distance_m"), "rank").join(trees.withColumn("_id", F.col("id").cast("string")), "_id").drop("_id")
    return x.withColumns({"status": F.lit("observed_council_inventory"), "limitation": F.lit("public trees only; fields and dates differ by council")})


def context_by_address(requests: DataFrame, addresses: DataFrame, layers: dict[str, DataFrame], radius: float, limit: int) -> tuple[DataFrame, DataFrame]:
    """What is around the address that each request resolves to, and the state of each request."""
    found = resolve(requests, addresses)
    centres = found.where("status = 'resolved'").select(F.col("request_id").alias("centre_id"), F.col("x").alias("cx"), F.col("y").alias("cy"))
    return environment_context(centres, layers, radius, limit), found


def geocoder_text(label) -> Column:
    """A geocoder's label as an address text: without country, state and commas, upper case."""
    x = F.regexp_replace(F.col(label) if isinstance(label, str) else label, r"(?i),\s*Australia$", "")
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)\b(Victoria|VIC)\b", ""), ",", " ")
    return F.upper(F.trim(F.regexp_replace(x, r"\s+", " ")))


# How a request asks for a part of a building.
UNIT_REQUEST = r"(?i)^\s*(unit|apt|apartment|flat)\b|\d\s*/"


def wants_unit(request) -> Column:
    """Whether a request asks for a unit, by its first word or a number before a slash."""
    return F.coalesce((F.col(request) if isinstance(request, str) else request).rlike(UNIT_REQUEST), F.lit(False))


def parcel_at(requests: DataFrame, parcels: DataFrame, precise: bool = False) -> DataFrame:
    """The parcel at each request's place (request_id, request, x, y): of several the smallest for a unit or a precise click, else the largest."""
    from greenlake.operators.spatial_join import points_in_areas

    hits = points_in_areas(requests.select("request_id", "request", "x", "y"), parcels.select("parcel_id", "area_m2", "xmin", "ymin", "xmax", "ymax"))
    small = F.lit(precise) | wants_unit("request")
    order = F.struct(F.when(small, F.col("area_m2")).otherwise(-F.col("area_m2")), "parcel_id")
    best = hits.groupBy("request_id").agg(F.min_by("parcel_id", order).alias("parcel_id"))
    return requests.select("request_id", "request").join(best, "request_id", "left")


def distance_status(metres) -> Column:
    """How local an observation is, by its distance."""
    d = F.col(metres) if isinstance(metres, str) else metres
    return (
        F.when(d.isNull(), "unavailable_no_observation_within_3_hours").when(d <= 10_000, "good_local_context")
        .when(d <= 25_000, "regional_context_warning").otherwise("too_distant_temperature_suppressed")
    )


# Labels of property and address codes.
PROPERTY_TYPES = {"O": "Occupancy", "G": "Graphic entity"}
ADDRESS_CLASSES = {"S": "Standard", "M": "Miscellaneous"}
