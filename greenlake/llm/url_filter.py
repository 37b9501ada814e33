"""URL filtering by host-suffix and path-prefix expressions (DataFrame functions only).

Each URL expands into the joins of its host suffixes and its slash-ended path prefixes. The rules'
own expressions are equi-joined on a short prefix of their SHA-256; the full digest and the rule's
path then confirm a hit, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_HEX = 8


def split_url(url) -> tuple:
    """Host and path columns; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _digest(expression):
    full = F.sha2(expression, 256)
    return F.substring(full, 1, PREFIX_HEX), full


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Verdict for every row of ``urls``.

    ``rules`` has string columns host, path and verdict. A rule fits its host and all subdomains when
    the URL's path starts with the rule's path. The longest rule text wins, then the longest host, then
    block before allow. Returns id, host, path, rule and verdict; a URL that no rule fits gets
    ``default`` and a null rule. Null ids and repeated rows keep one output row each; rules with a null
    part are ignored; with no rules every URL gets ``default``. Other columns are not read.
    """
    # A rule is found through its path up to the last slash; the rest of the path is confirmed after the join.
    r = (
        rules.where("host is not null and path is not null and verdict is not null")
        .select(
            F.translate("host", UPPER, LOWER).alias("r_host"),
            F.col("path").alias("r_path"),
            F.regexp_extract("path", r"(?s)^.*/|^", 0).alias("r_head"),
            F.col("verdict").alias("r_verdict"),
        )
        .distinct()
    )
    short, full = _digest(F.concat("r_host", F.lit("\n"), "r_head"))
    r = r.withColumns({"short": short, "full": full, "rule": F.concat("r_host", "r_path")})
    # Expressions beyond the deepest rule cannot match, so very long hosts and paths stay cheap.
    deep = r.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.max(F.size(F.split("r_head", "/"))).alias("parts")
    ).first()
    labels, parts = deep["labels"] or 0, deep["parts"] or 0

    host, path = split_url(F.col(url_col))
    u = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    u = u.groupBy("id", "host", "path").agg(F.count("*").alias("copies"))
    hosts, paths = F.split("host", r"\."), F.split("path", "/")
    n_host, n_path = F.size(hosts), F.size(paths)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(n_host, F.lit(max(labels, 1)))), lambda i: F.array_join(F.slice(hosts, -i, i), ".")
    )
    heads = F.transform(
        F.sequence(F.lit(0), F.least(n_path - 1, F.lit(parts))),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(paths, 1, i), "/"), F.lit("/"))),
    )
    u = u.withColumns({"suffixes": suffixes, "heads": heads})
    pairs = F.flatten(F.transform("suffixes", lambda s: F.transform("heads", lambda h: F.concat(s, F.lit("\n"), h))))
    x = u.select("id", "host", "path", "copies", F.explode(pairs).alias("expression"))
    short, full = _digest(F.col("expression"))
    x = x.select("id", "host", "path", "copies", short.alias("short"), full.alias("x_full"))
    hit = x.join(
        r, (x["short"] == r["short"]) & (x["x_full"] == r["full"]) & F.startswith(x["path"], r["r_path"]), "left"
    )
    rank = F.struct(F.length("rule"), F.length("r_host"), (F.col("r_verdict") == "block").cast("int"), "rule", "r_verdict")
    best = hit.groupBy("id", "host", "path", "copies").agg(F.max(F.when(F.col("rule").isNotNull(), rank)).alias("best"))
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
