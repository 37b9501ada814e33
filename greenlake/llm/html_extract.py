"""Main text of web pages with a site style tree for each host.

All pages of a host are merged into one tree of style nodes (paths of tags and classes). A node's
importance joins the entropy of its presentation (the child sequences that its pages show) with the
information of its content (1 less log_m c for a block text on c of the host's m pages). As entropy says
nothing on few pages, it is weighed against a prior worth some pages: names of page furniture speak against a node, an
article or main element for it. Menus and sidebars of their own on every page look to entropy as articles do, however large
the host, so a name is worth a multiple of the host's pages and outweighs entropy; entropy decides about all nodes without one.
Branches of low weighed importance are cut from every page, inside the article too. Reader comments and forms go by name alone.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.llm.common import map_batches, written
from greenlake.llm.url_filter import split_url

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|video|audio|canvas|select"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
FURNITURE_TAGS = frozenset("head nav footer aside dialog menu".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promoted banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs pagination pager sidebar sidebars aside widget widgets related share sharing social "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "footer masthead topbar search".split()
)
READER_TAGS = frozenset("form button".split())
READER_WORDS = frozenset("comment comments commentlist disqus respond reply replies form".split())
#: Marks of a node's label: page furniture, readers' and forms' parts.
FURNITURE, READER = "!f", "!r"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + RAW + r")(?=[\s/>])(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|/(?!>)|[^>/])*+(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>|<[!?][^>]*+>",
    re.S | re.I,
)
_ATTR = re.compile(r"\b(class|id|role|hidden|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d+")
_NAME_WORDS = re.compile(r"[a-z]+")


def _style(tag: str, attrs: str) -> tuple[str, str]:
    """A node's style label, and its mark."""
    names, mark = "", READER if tag in READER_TAGS else FURNITURE if tag in FURNITURE_TAGS else ""
    if attrs and tag not in ("html", "body"):
        for key, a, b, c in _ATTR.findall(attrs):
            value, key = (a or b or c).lower(), key.lower()
            if key in ("class", "id"):
                names += "." + ".".join(sorted(_DIGITS.sub("", value).replace("/", "_").replace("!", "_").split()))
                if tag not in ("article", "main"):
                    words = _NAME_WORDS.findall(value)
                    if not READER_WORDS.isdisjoint(words):
                        mark = READER
                    elif not FURNITURE_WORDS.isdisjoint(words):
                        mark = mark or FURNITURE
            elif (key == "role" and not FURNITURE_ROLES.isdisjoint(value.split())) or (key == "style" and "display:none" in value.replace(" ", "")):
                mark = mark or FURNITURE
    return tag + names, mark


def parse(page: str | None):
    """Blocks and nodes of a page in page order.

    Blocks are (path, text); nodes are (path, child labels) of the elements that hold others. A label ends in its
    mark, if it has one. White space inside a block is one space.
    """
    page = page or ""
    stack: list[list] = []  # tag, path, marked, in article, children
    blocks, nodes, buffer = [], [], []
    here = ["", "", False, False, []]

    def flush():
        if buffer:
            text = " ".join(_html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                blocks.append(((stack[-1] if stack else here)[1], text))

    def pop():
        x = stack.pop()
        if x[4]:
            nodes.append((x[1], tuple(x[4])))

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            buffer.append(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if m[2]:
            if not any(x[0] == tag for x in stack):
                continue
            if tag not in INLINE:
                flush()
                while stack[-1][0] != tag:
                    pop()
                pop()
            else:  # an inline end tag closes no block
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        if stack[i][1] != (stack[i - 1][1] if i else ""):
                            flush()
                        if all(x[0] in INLINE for x in stack[i:]):
                            del stack[i:]
                        break
                    if stack[i][0] not in INLINE:
                        break
            continue
        if tag == "br":
            buffer.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            if tag == "body":
                while stack and stack[-1][0] != "html":
                    pop()
            elif tag in CLOSES_P:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] not in INLINE:
                        break
            elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in same:
                        while len(stack) > i:
                            pop()
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "tr", "select", "menu") and stack[i][0] != tag:
                        break
        label, mark = _style(tag, m[4])
        up = stack[-1] if stack else here
        if tag == "header" and not up[3]:
            mark = mark or FURNITURE
        if mark and tag in INLINE:
            flush()
        own = tag not in INLINE or mark  # other inline elements are no nodes
        if own:
            label += mark
            top = next((x for x in reversed(stack) if x[0] not in INLINE), here)
            top[4].append(label)
        stack.append([tag, f"{up[1]}/{label}" if own else up[1], up[2] or bool(mark), up[3] or tag in ("article", "main"), []])
        if m[4].endswith("/") and tag not in INLINE:
            pop()
    if at < len(page):
        buffer.append(page[at:])
    flush()
    while stack:
        pop()
    return blocks, nodes


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "replace")) - (1 << 63)


def _node(host: str | None, path: str) -> int:
    return _hash(f"{host}\n{path}")


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html", plain_pages: int = 10, name_pages: int = 200, name_share: float = 3.0) -> DataFrame:
    """Rows (node, host, path, pages, importance, weighed) of every style node of every host.

    Pages of a host with the same unmarked blocks count once. importance is by entropy alone; weighed takes in
    the prior: 0 for furniture and 1 for an article or main element, worth ``name_share`` times the host's
    pages and ``name_pages`` at least, 0.5 for others, worth ``plain_pages``, and 0 for what readers and forms add. Hashes of what each page shows are counted by partial
    aggregates, so a host with most of the pages is never gathered.
    """
    host, _ = split_url(F.col(url_col))

    def make():
        names: dict = {}

        def fn(hosts, texts):
            seen, fresh = set(), {}
            for h, page in zip(hosts, texts):
                blocks, nodes = parse(page)
                same = _hash("\n".join(t for p, t in blocks if "!" not in p))
                ids = {p: _node(h, p) for p in {"", *(p for p, _ in blocks), *(p for p, _ in nodes)}}
                seen.update((ids[p], 1, _hash("\n".join(c)), same) for p, c in nodes)
                seen.update((ids[p], 2, _hash(t), same) for p, t in blocks)
                seen.add((ids[""], 0, 0, same))
                fresh.update((i, (h, p)) for p, i in ids.items() if i not in names)
            names.update(dict.fromkeys(fresh))
            if len(names) > 1_000_000:
                names.clear()
            none = [None] * len(fresh)
            a, b, c, d = zip(*seen) if seen else ((), (), (), ())
            return [
                [*fresh, *a], [*(x[0] for x in fresh.values()), *[None] * len(a)], [*(x[1] for x in fresh.values()), *[None] * len(a)],
                [*none, *b], [*none, *c], [*none, *d],
            ]

        return fn

    rows = map_batches(
        pages.select(host.alias("host"), F.col(html_col)), make,
        "node bigint, host string, path string, shown int, value bigint, page bigint",
    ).distinct()
    rows = written(rows, "style-nodes")
    n = F.col("n").cast("double")
    counts = rows.where("shown is not null").groupBy("node", "shown", "value").agg(F.count("*").alias("n"))
    sums = counts.groupBy("node").agg(*(
        F.sum(F.when(F.col("shown") == k, x)).alias(name)
        for k, x, name in ((0, n, "m"), (1, n, "m_p"), (1, n * F.log(n), "s_p"), (2, n, "k_c"), (2, n * F.log(n), "s_c"))
    ))
    named = rows.where("shown is null").select("node", "host", "path").join(sums, "node")  # one row for each style node
    named = written(named, "style-names")
    sites = named.where("path = ''").select(F.col("host").alias("_host"), "m")
    # What a node's descendants tell counts for it too.
    steps = F.split("path", "/")
    ups = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    told = named.where("k_c is not null").select("host", F.explode(ups).alias("path"), "k_c", "s_c")
    told = told.groupBy("host", "path").agg(F.sum("k_c").alias("k_c"), F.sum("s_c").alias("s_c"))
    x = named.drop("m", "k_c", "s_c").alias("n").join(told.alias("t"), F.expr("n.host <=> t.host and n.path = t.path"), "left")
    x = x.select("n.*", "t.k_c", "t.s_c").join(sites, F.col("host").eqNullSafe(F.col("_host")))
    shows = F.when(F.col("m_p") > 1, (F.log("m_p") - F.col("s_p") / F.col("m_p")) / F.log("m_p")).otherwise(F.when(F.col("m_p").isNotNull(), 1.0))
    tells = F.when(F.col("k_c").isNull(), 0.0).when(F.col("m") > 1, 1 - F.col("s_c") / F.col("k_c") / F.log("m")).otherwise(1.0)
    # A node that holds text alone always shows the same.
    x = x.withColumn("importance", (F.coalesce(shows, F.lit(0.0)) + tells) / 2)
    last = F.element_at(steps, -1)
    named_for = F.regexp_like(last, F.lit(r"^(article|main)(\.|$)"))
    against = F.col("path").contains(FURNITURE)
    worth = F.when(named_for | against, F.greatest(F.lit(float(name_pages)), name_share * F.col("m"))).otherwise(float(plain_pages))
    prior = F.when(against, 0.0).when(named_for, 1.0).otherwise(0.5)
    weighed = (F.col("m") * F.col("importance") + worth * prior) / (F.col("m") + worth)
    return x.select(
        "node", "host", "path", F.col("m").cast("long").alias("pages"), "importance",
        F.when(F.col("path").contains(READER), 0.0).otherwise(weighed).alias("weighed"),
    )


def main_text(page: str | None, low=None) -> str:
    """The page's blocks joined by two line ends, without those whose path is in ``low``; without ``low`` all marked ones go."""
    blocks, _ = parse(page)
    return "\n\n".join(text for path, text in blocks if (path not in low if low is not None else "!" not in path))


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_importance: float = 0.28,
    plain_pages: int = 10, name_pages: int = 200, broadcast_nodes: int = 1_000_000,
) -> DataFrame:
    """Main text of every page: id, url, text and n_chars (code points).

    A block goes when the weighed importance of its node on its host (see :func:`style_tree`) is below ``min_importance``.
    Null or empty html gives an empty text; a null URL or one without a host is judged with all such pages
    as one host. Equal pages are judged alike. Repeated rows and null ids keep one output row each; other columns are not read. Up to
    ``broadcast_nodes`` low nodes (8 bytes each) go to every task; more are joined to the nodes of each page.
    """
    tree = style_tree(pages, url_col, html_col, plain_pages, name_pages)
    low = written(tree.where(F.col("weighed") < min_importance).select("node"), "style-tree")
    few = low.limit(broadcast_nodes + 1).count() <= broadcast_nodes
    table = np.sort(np.array([r["node"] for r in low.collect()] if few else [], np.int64))
    host, _ = split_url(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"), host.alias("_host"))
    if not few:
        # The nodes of each page that are low on its host, by equi-join; bounded by the page's own nodes.
        rows = rows.withColumn("_key", F.xxhash64("_host", "_html"))

        def nodes():
            def fn(hosts, keys, texts):
                found = [(k, n) for h, k, page in zip(hosts, keys, texts) for n in {_node(h, p) for p, _ in parse(page)[0]}]
                return [x[0] for x in found], [x[1] for x in found]

            return fn

        said = map_batches(rows.select("_host", "_key", "_html"), nodes, "key bigint, node bigint").distinct()
        said = said.join(low, "node").groupBy("key").agg(F.collect_list("node").alias("_low"))
        rows = rows.join(said, F.col("_key") == F.col("key"), "left").select("_id", "_url", "_html", "_host", "_low")
    kind = pages.schema[id_col].dataType.simpleString()

    def make():
        judged: dict = {}

        def is_low(h, path):
            known = judged.get((h, path))
            if known is None:
                if len(judged) > 500_000:
                    judged.clear()
                node = _node(h, path)
                at = np.searchsorted(table, node)
                known = judged[h, path] = bool(at < len(table) and table[at] == node)
            return known

        def fn(ids, urls, texts, hosts, *own):
            out = []
            for i, (h, page) in enumerate(zip(hosts, texts)):
                blocks, _ = parse(page)
                low = set(own[0][i] or ()) if own else ()
                out.append("\n\n".join(t for p, t in blocks if not (_node(h, p) in low if own else is_low(h, p))))
            return ids, urls, pa.array(out, pa.string()), [len(x) for x in out]

        return fn

    return map_batches(rows, make, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars bigint")
