"""Taxon matching: candidates, fuzzy matches within a genus, precedence, licences and image choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenlake.functions.text import col

# Words of an image's texts that speak for a whole tree, or for a part of one.
FULL_TREE = ("adult", "habit", "habitus", "mature", "street tree", "tree", "whole tree")
DETAIL = (
    "bark", "branch", "bud", "close-up", "closeup", "flower", "foliage", "fruit", "herbarium", "leaf", "leaves", "seed",
    "seedling", "specimen", "twig",
)


def binomials(name) -> Column:
    """The names of genus and epithet within a text."""
    return F.array_distinct(F.regexp_extract_all(col(name), F.lit(r"\b([A-Z][a-z]{2,}\s+[a-z][a-z-]{2,})\b"), 1))


def hybrid_name(name) -> Column:
    """``Genus x epithet`` with the proper sign, or null."""
    g, e = F.regexp_extract(col(name), r"^([A-Z][a-z]+)\s+[xX×]\s*([a-z]+)\b", 1), F.regexp_extract(col(name), r"^([A-Z][a-z]+)\s+[xX×]\s*([a-z]+)\b", 2)
    return F.when(g != "", F.concat(g, F.lit(" × "), e))


def similarity(a, b) -> Column:
    """1 less the edit distance over the longer length."""
    return 1 - F.levenshtein(col(a), col(b)) / F.greatest(F.length(col(a)), F.length(col(b)))


def _grams(text: Column, q: int) -> Column:
    """The ``q``-grams of a text with blanks of its own around it, each with the number of its occurrence, so that none stands twice."""
    padded = F.concat(F.lit("\x02" * (q - 1)), text, F.lit("\x02" * (q - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) + q - 1), lambda i: F.substring(padded, i, F.lit(q)))
    return F.transform(grams, lambda g, i: F.concat(g, F.lit("\x03"), F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string")))


def similar_names(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs (left, right, similarity) of the distinct texts of two tables with one column each, for a similarity of at least ``least``.

    An edit touches q of a text's q-grams at most, so two texts within d edits share all but ``q * d`` of the longer one's. Texts
    are met through lists of their rarest q-grams alone, just as many as cannot all be missing from a similar text; what is met must
    then pass the bounds on length and shared q-grams before the distance is measured. Common letters make no hot keys, as
    only a text without any rarer q-gram is listed under them. Below 0.5 no q-gram need be shared, so that is an error.
    """
    if not 0.5 <= least <= 1:
        raise ValueError("least must be within 0.5 and 1")
    q = 3 if least >= 2 / 3 else 2
    edits = lambda n: F.floor((1 - F.lit(least)) * n + 1e-9).cast("int")
    shared = lambda n: n + (q - 1) - q * edits(n)  # noqa: E731  of texts of which the longer has n letters
    (a,), (b,) = left.columns, right.columns
    both = left.select(F.col(a).alias("text"), F.lit(0).alias("side")).unionByName(right.select(F.col(b).alias("text"), F.lit(1).alias("side")))
    both = both.where("text <> ''").distinct().withColumn("n", F.length("text")).withColumn("grams", _grams(F.col("text"), q))
    # Outer, as from a plain one the optimizer takes a filter on the q-grams that it pushes below the distinct, where they'd be made for every row.
    each = both.select("text", "side", "n", F.explode_outer("grams").alias("gram"))
    often = each.groupBy("gram").agg(F.count("*").alias("often"))
    # The fewest q-grams that a similar text shares, over all lengths that it may have.
    fewest = F.array_min(F.transform(F.sequence("n", F.floor(F.col("n") / F.lit(least) + 1e-9).cast("int")), shared))
    ranked = each.join(often, "gram").groupBy("text", "side", "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("often", "gram"))), lambda g: g["gram"]).alias("grams"))
    listed = ranked.withColumn("rare", F.slice("grams", F.lit(1), F.size("grams") - F.greatest(fewest, F.lit(1)) + 1)).withColumn("gram", F.explode("rare"))
    name = lambda side: listed.where(F.col("side") == side).select("gram", *(F.col(c).alias(f"{c}{side}") for c in ("text", "n", "grams", "rare")))
    x = name(0).join(name(1), "gram")
    longer = F.greatest("n0", "n1")
    # A pair that meets under several q-grams counts under the first.
    x = x.where((F.abs(F.col("n0") - F.col("n1")) <= edits(longer)) & (F.array_intersect("rare0", "rare1")[0] == F.col("gram")) & (F.size(F.array_intersect("grams0", "grams1")) >= shared(longer)))
    x = x.withColumn("similarity", similarity("text0", "text1")).where(F.col("similarity") >= least)
    return x.select(F.col("text0").alias("left"), F.col("text1").alias("right"), "similarity")


def fuzzy_matches(names: DataFrame, titles: DataFrame, least: float = 0.94, margin: float = 0.003) -> DataFrame:
    """The one title of the same genus and first two epithet letters that is similar enough and clearly the best."""
    block = lambda c: F.lower(F.regexp_extract(c, r"^(\S+\s+\S{2})", 1))
    x = similar_names(names.select(F.lower("name")), titles.select(F.lower("title")), least).where("left <> right")
    x = x.where((block("left") == block("right")) & (block("left") != "")).select(F.col("left").alias("name"), F.col("right").alias("title"), "similarity")
    w = Window.partitionBy("name").orderBy(F.desc("similarity"), "title")
    x = x.withColumns({"rank": F.row_number().over(w), "next": F.lead("similarity").over(w)})
    return x.where((F.col("rank") == 1) & (F.col("next").isNull() | (F.col("similarity") - F.col("next") >= margin))).select("name", "title", "similarity")


def accepted(matches: DataFrame) -> DataFrame:
    """The best acceptable match of each name: exact, of 95 or surer, a plant; the candidate kind decides, then confidence."""
    good = matches.where("match_type = 'EXACT' and confidence >= 95 and kingdom = 'Plantae'")
    rank = F.when(F.col("candidate_kind") == "original", 0).when(F.col("candidate_kind") == "embedded_scientific_name", 1).when(F.col("candidate_kind") == "normalized_hybrid_name", 2).otherwise(3)
    best = good.groupBy("name").agg(F.min_by("matched_name", F.struct(rank, -F.col("confidence"), F.col("matched_name"))).alias("matched_name"))
    return matches.select("name").distinct().join(best, "name", "left").withColumn("status", F.when(F.col("matched_name").isNull(), "unresolved").otherwise("accepted"))


def clean_https(url) -> Column:
    u = F.regexp_replace(F.trim(col(url)), "^http://", "https://")
    return F.when(F.startswith(u, F.lit("https://")), u)


def strip_markup(text) -> Column:
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(col(text), "<[^>]+>", " "), r"\s+", " ")), F.lit(""))


def image_score(text, preferred) -> Column:
    """300 for the preferred title, 80 for each whole-tree term, less 120 for each detail term."""
    t = F.lower(col(text))
    plus = sum((F.contains(t, F.lit(w)).cast("int") * 80 for w in FULL_TREE), F.lit(0))
    minus = sum((F.contains(t, F.lit(w)).cast("int") * 120 for w in DETAIL), F.lit(0))
    return F.when(col(preferred), 300).otherwise(0) + plus - minus


def resolve_redirects(links: DataFrame, most: int = 5) -> DataFrame:
    """The end of each chain of redirects (source, target), following at most ``most`` steps."""
    x = links.select("source", F.col("target").alias("final"))
    step = links.select(F.col("source").alias("final"), F.col("target").alias("_next"))
    for _ in range(most - 1):
        x = x.join(step, "final", "left").select("source", F.coalesce("_next", "final").alias("final"))
    return x
