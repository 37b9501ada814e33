"""Text and number normalisers as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
PLACEHOLDERS = (
    "", "-", "n/a", "na", "none", "null", "unknown", "not applicable", "not appliable", "not specified",
    "to be determined", "tbd",
)

# Street-type abbreviations with one meaning. ST is left alone: it also means Saint.
STREET_TYPES = (
    ("RD", "ROAD"), ("AVE", "AVENUE"), ("AV", "AVENUE"), ("BLVD", "BOULEVARD"), ("CRES", "CRESCENT"), ("CT", "COURT"),
    ("DR", "DRIVE"), ("HWY", "HIGHWAY"), ("LN", "LANE"), ("PDE", "PARADE"), ("PL", "PLACE"), ("TCE", "TERRACE"),
)

# Abbreviations that a typed prefix may mean.
PREFIX_TYPES = {
    "AV": "AVENUE", "AVE": "AVENUE", "BLVD": "BOULEVARD", "BVD": "BOULEVARD", "CL": "CLOSE", "CR": "CRESCENT",
    "CRES": "CRESCENT", "CT": "COURT", "DR": "DRIVE", "ESP": "ESPLANADE", "GR": "GROVE", "HWY": "HIGHWAY", "LN": "LANE",
    "PDE": "PARADE", "PL": "PLACE", "RD": "ROAD", "ST": "STREET", "TCE": "TERRACE", "WY": "WAY",
}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(value, ready: bool = False) -> Column:
    """White space collapsed and trimmed; a placeholder becomes null. With ``ready`` the value has been through this already."""
    if ready:
        return col(value)
    text = F.trim(F.regexp_replace(col(value).cast("string"), r"\s+", " "))
    return F.when(~F.lower(text).isin(*PLACEHOLDERS), text)


def number(value) -> Column:
    """A finite double, or null."""
    x = col(value).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def positive_float(value, scale: float = 1.0, ready: bool = False) -> Column:
    x = number(F.regexp_replace(clean(value, ready), ",", "")) * F.lit(scale)
    return F.when(x > 0, F.round(x, 4))


def numeric_range(value, scale: float = 1.0, ready: bool = False) -> Column:
    """Struct (minimum, maximum) of the positive numbers in a text."""
    found = F.regexp_extract_all(clean(value, ready), F.lit(r"(\d+(?:\.\d+)?)"), 1)
    some = F.filter(F.transform(found, lambda x: x.cast("double") * scale), lambda x: x > 0)
    return F.struct(F.round(F.array_min(some), 4).alias("minimum"), F.round(F.array_max(some), 4).alias("maximum"))


def iso_date(value, ready: bool = False) -> Column:
    return F.try_to_date(F.substring(clean(value, ready), 1, 10), "yyyy-MM-dd")


def scientific_name(genus, species, ready: bool = False) -> Column:
    """Struct (name, precision) from a genus and a species text."""
    g, s = clean(genus, ready), clean(species, ready)
    bare = s.isNull() | F.lower(s).isin("sp", "sp.", "species")
    expanded = F.regexp_replace(s, r"^[A-Za-z]\.\s*(?=.)", "")
    name = (
        F.when(g.isNull(), s)
        .when(bare, F.concat(g, F.lit(" sp.")))
        .when(F.startswith(F.lower(s), F.concat(F.lower(g), F.lit(" "))), s)
        .otherwise(F.concat(g, F.lit(" "), expanded))
    )
    precision = F.when(name.isNull(), F.lit(None).cast("string")).when(g.isNotNull() & bare, "genus").otherwise("species")
    return F.struct(name.alias("name"), precision.alias("precision"))


def stable_id(key, *parts) -> Column:
    """``key:`` and 32 hex digits of the parts' SHA-256; null parts count as empty."""
    said = F.concat_ws("|", *(F.coalesce(F.trim(col(p).cast("string")), F.lit("")) for p in parts))
    key = F.lit(key) if isinstance(key, str) else key
    return F.concat(key, F.lit(":"), F.substring(F.sha2(said, 256), 1, 32))


def council_name(value) -> Column:
    """Upper case without the words of incorporation; empty becomes null."""
    x = F.regexp_replace(F.upper(F.trim(col(value))), r"^CITY OF\s+", "")
    return F.nullif(F.regexp_replace(x, r"\s+(CITY COUNCIL|CITY)$", ""), F.lit(""))


def normalize_address(value) -> Column:
    """Upper case, single spaces, and whole-word street types spelled out."""
    x = F.regexp_replace(F.trim(F.upper(col(value))), r"\s+", " ")
    return reduce(lambda acc, w: F.regexp_replace(acc, rf"\b{w[0]}\b", w[1]), STREET_TYPES, x)


def prefix_candidates(value, most: int = 8) -> Column:
    """Upper-cased prefixes to try: as typed first, then with each abbreviated word kept or spelled out."""
    meaning = F.create_map(*(F.lit(x) for pair in PREFIX_TYPES.items() for x in pair))

    def grow(done, word):
        ways = F.filter(F.array(word, F.try_element_at(meaning, word)), lambda w: w.isNotNull())
        longer = F.flatten(F.transform(done, lambda d: F.transform(ways, lambda w: F.when(d == "", w).otherwise(F.concat(d, F.lit(" "), w)))))
        return F.slice(F.array_distinct(longer), 1, most)

    words = F.filter(F.split(F.upper(F.trim(col(value))), r"\s+"), lambda w: w != "")
    return F.aggregate(words, F.array(F.lit("")), grow)


def blank(value) -> Column:
    """Null, or a text of white space only."""
    return col(value).isNull() | (F.trim(col(value).cast("string")) == "")
