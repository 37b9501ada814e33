"""Tree species: popularity by council, guidance, catalogue, prices and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenlake.functions.text import council_name

# Option codes of priced trees, statuses that carry a size, and licences that may be shown.
TREE_OPTIONS = ("backyard_tree_diy", "backyard_tree_installed")
SIZED = ("exact_variant_size_price", "exact_listed_size_price", "single_product_price_with_size_label")
MEASURED = ("height_m", "canopy_width_m", "diameter_breast_height_cm")
# What a taxon match must be, and the form of the name that it gives.
MATCH, LEAST_CONFIDENCE, RANK = "EXACT", 95, "SPECIES"
MATCHED_NAME = r"^[A-Z][A-Za-z.-]+(\s+[x×])?\s+[a-z][A-Za-z.-]+"
COMMON_NAMES = {"lophostemon confertus": "Brush Box", "eucalyptus leucoxylon": "Yellow Gum"}


def _text(c) -> Column:
    return F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit(""))


def species_key(scientific="scientific_name", common="common_name") -> Column:
    return F.when(_text(scientific).isNotNull(), F.concat(F.lit("scientific:"), F.lower(_text(scientific)))).otherwise(F.concat(F.lit("common:"), F.lower(_text(common))))


def representative(value: str, low: str, high: str) -> Column:
    """The value, else the middle of its range."""
    return F.coalesce(F.col(value), (F.col(low) + F.col(high)) / 2)


def popularity(trees: DataFrame, councils: DataFrame, guidance: DataFrame | None = None, limit: int = 10) -> DataFrame:
    """The most recorded species of every council, with share, medians, and the council's guidance.

    ``trees`` carry the council (lga_code) that holds them and their source's municipality; only records of
    the council's own inventory count. Crown, trunk, source_name and licence are told where ``trees`` has them: medians, and the lists of
    all sources and licences that a species' records come from. A council without one gets the ten most recorded species overall,
    marked as such; one row marked unavailable stands where there is nothing at all.
    """
    t = trees.where(_text("scientific_name").isNotNull() | _text("common_name").isNotNull()).withColumn("species_key", species_key())
    c = councils.select("lga_code", council_name("lga_name").alias("_council"))
    own = t.join(c, "lga_code").where(council_name("municipality") == F.col("_council"))

    def counted(df, *by):
        return df.groupBy(*by, "species_key").agg(
            F.min(_text("scientific_name")).alias("scientific_name"), F.min(_text("common_name")).alias("common_name"), F.count("*").alias("n_trees"),
            *(F.round(F.percentile(c, F.lit(0.5)), 2).alias(f"median_{c}") for c in MEASURED if c in df.columns or c == "height_m"),
            *(F.array_sort(F.collect_set(_text(c))).alias(f"{c}s") for c in ("source_name", "licence") if c in df.columns),
        )

    def ranked(df, *by):
        total = df.groupBy(*by).agg(F.sum("n_trees").alias("_all")) if by else df.agg(F.sum("n_trees").alias("_all"))
        w = Window.partitionBy(*by).orderBy(F.desc("n_trees"), F.coalesce("common_name", "scientific_name"), "species_key")
        x = df.join(total, list(by)) if by else df.join(F.broadcast(total), F.lit(True))
        return x.withColumn("popularity_rank", F.row_number().over(w)).withColumn("share_pct", F.round(100.0 * F.col("n_trees") / F.col("_all"), 2)).drop("_all")

    local = ranked(counted(own, "lga_code"), "lga_code").where(F.col("popularity_rank") <= limit)
    # The whole area's top ten come from a sort with a limit, not from one window over all species.
    everywhere = counted(t)
    total = everywhere.agg(F.sum("n_trees").alias("_all"))
    top = everywhere.orderBy(F.desc("n_trees"), F.coalesce("common_name", "scientific_name"), "species_key").limit(min(limit, 10))
    top = top.join(F.broadcast(total), F.lit(True)).withColumn("share_pct", F.round(100.0 * F.col("n_trees") / F.col("_all"), 2)).drop("_all")
    top = top.withColumn("popularity_rank", F.row_number().over(Window.orderBy(F.desc("n_trees"), F.coalesce("common_name", "scientific_name"), "species_key")))
    without = councils.select("lga_code").join(local.select("lga_code").distinct(), "lga_code", "left_anti")
    spare = without.join(F.broadcast(top), F.lit(True), "left")
    spare = spare.withColumn("status", F.when(F.col("species_key").isNull(), "unavailable_no_integrated_council_inventory").otherwise("fallback_overall_observed_public_tree_frequency"))
    out = local.withColumn("status", F.lit("observed_public_tree_frequency")).unionByName(spare)
    if guidance is None:
        return out
    return out.join(guidance_category(out, guidance), ["lga_code", "species_key"], "left").withColumn("list_category", F.coalesce("list_category", F.when(F.col("species_key").isNull(), "unavailable").otherwise("council_approval_required")))


def guidance_category(species: DataFrame, guidance: DataFrame) -> DataFrame:
    """(lga_code, species_key, list_category): not recommended before needing approval before available.

    Species meet guidance by scientific name, or by common name where they have no scientific one: both are
    one equi-join on the species key, as guidance rows carry a key for each name.
    """
    g = guidance.select("lga_code", "guidance_status", F.explode(F.array(species_key(), F.concat(F.lit("common:"), F.lower(_text("common_name"))))).alias("species_key")).where("species_key is not null").distinct()
    any_ = lambda *s: F.bool_or(F.col("guidance_status").isin(*s))
    x = species.select("lga_code", "species_key").distinct().join(g, ["lga_code", "species_key"])
    return x.groupBy("lga_code", "species_key").agg(
        F.when(any_("not_recommended"), "not_recommended").when(any_("conditional", "approval_required"), "council_approval_required")
        .when(any_("approved", "recommended"), "available_now").otherwise("council_approval_required").alias("list_category")
    )


def species_options(guidance: DataFrame, observed: DataFrame) -> DataFrame:
    """Guidance rows with their observed counts, and observed species that no guidance names."""
    o = observed.select("lga_code", "species_key", "n_trees")
    g = guidance.withColumn("species_key", species_key()).select("lga_code", "species_key", "guidance_status")
    listed = g.join(o, ["lga_code", "species_key"], "left").withColumn("n_trees", F.coalesce("n_trees", F.lit(0)))
    other = o.join(g.select("lga_code", "species_key"), ["lga_code", "species_key"], "left_anti")
    return listed.unionByName(other.withColumn("guidance_status", F.lit("not_in_loaded_guidance")).select(*listed.columns))


# Patterns of labels that name no single species.
UNRESOLVED = (r"(^|[ ,])sp\.?($|[ ,])", r"^(dead|stump)( |$)", r"(^| )(unknown|unidentified)( |$)", r"(^| )(species|cultivar|varieties)( |$)", r"(^| )cv\.?$", ",")


def resolved_identity(name) -> Column:
    x = F.lower(F.col(name) if isinstance(name, str) else name)
    bad = F.lit(False)
    for p in UNRESOLVED:
        bad = bad | x.rlike(p)
    return ~bad & x.rlike(r"^[a-z][a-z.-]+( [x×])? [a-z][a-z.-]+")


def exact_costs(costs: DataFrame) -> DataFrame:
    """Price range and sources of each priced species."""
    c = costs.where(_text("botanical_name").isNotNull() & F.col("option_code").isin(*TREE_OPTIONS)).withColumn("species_key", F.lower(_text("botanical_name")))
    on = lambda f, v, o: f(F.when(F.col("option_code") == o, F.col(v)))
    return c.groupBy("species_key").agg(
        F.min("tree_type").alias("priced_tree_type"), on(F.min, "minimum_cost", TREE_OPTIONS[0]).alias("supply_min"), on(F.max, "maximum_cost", TREE_OPTIONS[0]).alias("supply_max"),
        on(F.min, "minimum_cost", TREE_OPTIONS[1]).alias("installed_min"), on(F.max, "maximum_cost", TREE_OPTIONS[1]).alias("installed_max"), F.min("valid_to").alias("cost_valid_to"),
        F.array_join(F.sort_array(F.collect_set("source_name")), ",").alias("cost_sources"), F.bool_or(F.coalesce(F.col("size_price_status").isin(*SIZED), F.lit(False))).alias("sized"),
    )


def accepted_taxa(matches: DataFrame) -> DataFrame:
    """Keys of the species that a taxon match stands for: an exact one of a species, sure enough, with a full name."""
    sure = (F.col("match_type") == MATCH) & (F.col("match_confidence") >= LEAST_CONFIDENCE) & (F.upper("taxon_rank") == RANK)
    return matches.where(sure & F.col("matched_scientific_name").rlike(MATCHED_NAME)).select(F.lower(_text("scientific_name")).alias("species_key")).distinct()


def catalogue(profiles: DataFrame, costs: DataFrame, matches: DataFrame | None = None) -> DataFrame:
    """All profiled and priced species with their exact price range and why there is none.

    With taxon ``matches`` (scientific_name, match_type, match_confidence, taxon_rank, matched_scientific_name) a species is known only when its name
    is a full one and :func:`accepted_taxa` has it.
    """
    a = profiles.select(_text("scientific_name").alias("scientific_name"), _text("common_name").alias("common_name")).where("scientific_name is not null")
    b = costs.where(F.col("option_code").isin(*TREE_OPTIONS)).select(_text("botanical_name").alias("scientific_name"), _text("tree_type").alias("common_name")).where("scientific_name is not null")
    s = a.unionByName(b).groupBy(F.lower("scientific_name").alias("species_key")).agg(F.min("scientific_name").alias("scientific_name"), F.min("common_name").alias("common_name"))
    x = s.join(exact_costs(costs), "species_key", "left")
    priced, known = F.col("sized").isNotNull(), resolved_identity("scientific_name")
    if matches is not None:
        x = x.join(accepted_taxa(matches).withColumn("_match", F.lit(True)), "species_key", "left")
        known = known & F.col("_match").isNotNull()
    rest = F.when(~known, "unavailable_unresolved_tree_identity").otherwise("unavailable_no_species_quote")
    return x.withColumns({
        "tree_type": F.coalesce("priced_tree_type", "common_name", "scientific_name"), "cost_status": F.when(priced, "species_specific_current_source_range").otherwise(rest),
        "size_price_status": F.when(F.col("sized"), "species_size_price_available").when(priced, "species_price_size_unmapped").otherwise(rest),
    }).drop("sized", "priced_tree_type", "_match")


def planting_catalogue(popular: DataFrame, costs: DataFrame) -> DataFrame:
    """A council's popular species with prices, and the priced species beside them."""
    c = exact_costs(costs)
    p = popular.select("lga_code", F.lower("scientific_name").alias("species_key"), "popularity_rank", "list_category")
    listed = p.join(c, "species_key", "left")
    # Each priced species beside each council is the result's own size; the councils, some tens, travel in one row.
    lgas = popular.agg(F.collect_set("lga_code").alias("lga_code"))
    other = c.join(F.broadcast(lgas), F.lit(True)).withColumn("lga_code", F.explode("lga_code")).join(p.select("lga_code", "species_key"), ["lga_code", "species_key"], "left_anti")
    return listed.unionByName(other, allowMissingColumns=True)


def sized_prices(costs: DataFrame) -> DataFrame:
    """Prices that name a size, by species and size: (species_key, size, supply_min, supply_max, n)."""
    c = costs.where(F.col("option_code").eqNullSafe(TREE_OPTIONS[0]) & F.col("size_price_status").isin(*SIZED) & _text("botanical_name").isNotNull())
    return c.groupBy(F.lower(_text("botanical_name")).alias("species_key"), F.col("size_label").alias("size")).agg(
        F.min("minimum_cost").alias("supply_min"), F.max("maximum_cost").alias("supply_max"), F.count("*").alias("n")
    )


def supply_projection(requests: DataFrame, prices: DataFrame) -> DataFrame:
    """What a number of trees of a species and size costs to buy, or why that is not known."""
    x = requests.withColumn("species_key", F.lower(_text("species"))).join(prices.drop("n"), ["species_key", "size"], "left")
    good = F.coalesce(F.col("quantity") > 0, F.lit(False))
    status = F.when(~good, "bad_quantity").when(F.col("supply_min").isNull(), "no_price_of_this_size").otherwise("priced")
    total = lambda c: F.when(status == "priced", F.round(F.col(c) * F.col("quantity"), 2))
    return x.withColumns({"status": status, "total_min": total("supply_min"), "total_max": total("supply_max")}).drop("species_key")


def ordered_json(rows: DataFrame, by: list[str], order: list[str], fields: list[str], name: str = "items") -> DataFrame:
    """One JSON array of objects for each key, in the given order."""
    item = F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order)), F.struct(*fields).alias("v"))
    return rows.groupBy(*by).agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"])).alias(name))


def top_species(trees: DataFrame, k: int = 10) -> DataFrame:
    """The most recorded species with their most frequent common name, or the preferred one."""
    t = trees.where(_text("scientific_name").isNotNull()).withColumn("species_key", F.lower("scientific_name"))
    n = t.groupBy("species_key", "common_name").agg(F.count("*").alias("n"), F.min("scientific_name").alias("scientific_name"))
    best = n.groupBy("species_key").agg(
        F.min("scientific_name").alias("scientific_name"), F.sum("n").alias("n_trees"),
        F.min_by("common_name", F.when(F.col("common_name").isNotNull(), F.struct(-F.col("n"), "common_name"))).alias("common_name"),
    )
    preferred = F.try_element_at(F.create_map(*(F.lit(x) for p in COMMON_NAMES.items() for x in p)), F.col("species_key"))
    return best.withColumn("common_name", F.coalesce(preferred, "common_name")).orderBy(F.desc("n_trees"), "species_key").limit(k)


def choose_image(images: DataFrame, licences: DataFrame) -> DataFrame:
    """The image of each species under an allowed licence: curated first, then the newest."""
    x = images.join(licences, ["licence", "licence_url"], "left_semi")
    order = F.struct(F.col("curated").cast("int"), "updated_at", "image_url")
    rest = [c for c in x.columns if c != "species_key"]
    return x.groupBy("species_key").agg(F.max_by(F.struct(*rest), order).alias("i")).select("species_key", "i.*")


def quarantine_images(images: DataFrame, url: str = "image_url") -> DataFrame:
    """URLs that do not name an image become null and are marked."""
    good = F.lower(F.col(url)).rlike(r"^https://[^?#]+\.(jpe?g|png|gif|webp|svg|tiff?)([?#].*)?$")
    return images.withColumn("quarantined", F.col(url).isNotNull() & ~F.coalesce(good, F.lit(False))).withColumn(url, F.when(good, F.col(url)))
