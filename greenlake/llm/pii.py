"""Personal data: fixed patterns, then terms that reveal a protected value by corpus co-occurrence.

The protected entities are the values that the patterns find. For a term t within a few words of an
entity e, ``PMI(e, t) / IC(e) = ln(N n_et / (n_e n_t)) / ln(N / n_e)`` is the share of the entity's
information that the term gives away, with all counts in distinct documents of the whole corpus. A term is
disclosing where that share reaches the threshold even with one more document counted that has the term and
only the usual chance of the entity; so a term beside values seen once, or in many other places, is left alone.
Disclosing terms become their class (words of the same first three letters) where the class itself stays
below the threshold for every such entity, and are removed otherwise, wherever they occur.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.llm.common import fresh, map_batches, written

KINDS = ("email", "ip", "card", "phone", "term")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# The look-behinds only skip starts inside a digit run, where a match could not begin anyway.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\W_]{3,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns, leftmost non-overlapping for each kind."""
    if not text:
        return []
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shown(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _near(text: str, spans, window: int):
    """(entity, terms within ``window`` words of it) for each entity of a text."""
    words = [(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(text)]
    starts = [w[0] for w in words]
    near: dict[str, set] = {}
    for a, k, b in spans:
        left, right = bisect_right(starts, a), bisect_right(starts, b)
        around = words[max(0, left - window) : left] + words[right : right + window]
        entity = f"{KINDS[k]}:{text[a:b].lower() if k == 0 else _NOT_DIGIT.sub('.' if k == 1 else '', text[a:b])}"
        words_near = {w for s, e, w in around if not any(s < z and y < e for y, _, z in spans)}
        for name in (entity, pool_of(entity)):
            near.setdefault(name, set()).update(words_near)
    return near


def pool_of(entity: str) -> str:
    """What an entity shares with others: an address's domain, the first three parts of an IP, the first six digits of a number.

    Single values hardly ever return in unlike texts; a term that stands beside one domain again and again still gives it away.
    """
    kind, value = entity.split(":", 1)
    return f"{kind}@" + (value.rpartition("@")[2] if kind == KINDS[0] else value.rpartition(".")[0] if kind == KINDS[1] else value[:6])


def class_of(term: str) -> str:
    """The class that a term is generalised to."""
    return term[:3] + "*"


def term_counts(docs: DataFrame, text_col: str = "text", window: int = 8, flush: int = 200_000) -> DataFrame:
    """Document counts of entities, terms, classes of terms (ending in ``*``) and their pairs: columns entity, term, n, low, high.

    A null term counts an entity, a null entity counts a term, both null count the documents. For a pair, low and high are
    the least and greatest hash of the words around the entity: they differ when the pair stands in unlike surroundings, however many
    copies of each there are. Each task adds up before the shuffle and hands on its table whenever it holds ``flush`` keys.
    """

    def make():
        terms, held, low, high = Counter(), Counter(), {}, {}

        def rest():
            rows = [(None, w, n, None, None) for w, n in terms.items()] + [(*k, n, low.get(k), high.get(k)) for k, n in held.items()]
            for kept in (terms, held, low, high):
                kept.clear()
            return [list(x) for x in zip(*rows)] if rows else [[]] * 5

        def fn(texts):
            held[None, None] += len(texts)
            for text in texts:
                text = text or ""
                said = set(WORD.findall(text.lower()))
                terms.update(said)
                terms.update({class_of(w) for w in said})
                if spans := base_spans(text):
                    for entity, near in _near(text, spans, window).items():
                        held[entity, None] += 1
                        around = xxhash.xxh3_64_intdigest(" ".join(sorted(near))) - (1 << 63)
                        for w in near | {class_of(w) for w in near}:
                            held[entity, w] += 1
                            low[entity, w] = min(low.get((entity, w), around), around)
                            high[entity, w] = max(high.get((entity, w), around), around)
            return rest() if len(terms) + len(held) > flush else [[]] * 5

        return fn, rest

    df = map_batches(docs.select(text_col), make, "entity string, term string, n bigint, low bigint, high bigint")
    return df.groupBy("entity", "term").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def disclosing_terms(docs: DataFrame, text_col: str = "text", window: int = 8, min_support: int = 2, threshold: float = 0.9) -> DataFrame:
    """Terms that give away at least ``threshold`` of an entity's information: term, disclosure, replacement.

    Pairs seen in fewer than ``min_support`` documents carry no estimate and are left alone; two are the
    least at which a term and an entity return together. Copies of one text are one witness: a pair whose documents all have the
    same words around the entity is left alone too.
    """
    counts = written(term_counts(docs, text_col, window), "pii-counts")
    pairs = counts.where("entity is not null and term is not null").where((F.col("n") >= min_support) & (F.col("low") < F.col("high")))
    entities = counts.where("entity is not null and term is null").select("entity", F.col("n").alias("n_e"))
    terms = counts.where("entity is null and term is not null").select("term", F.col("n").alias("n_t"))
    total = float(counts.where("entity is null and term is null").agg(F.sum("n")).first()[0] or 0)

    def share(chance):
        return F.log(chance * total / F.col("n_e")) / F.log(total / F.col("n_e"))

    x = pairs.join(entities, "entity").where(F.col("n_e") < total).join(terms, "term")
    x = x.select(
        "entity", "term", share(F.col("n") / F.col("n_t")).alias("disclosure"),
        share((F.col("n") + F.col("n_e") / total) / (F.col("n_t") + 1)).alias("sure"),
    )
    x = written(x, "pii-shares")
    wide = x.where(F.col("term").endswith("*")).select("entity", F.col("term").alias("class"), F.col("disclosure").alias("wide"))
    found = x.where(~F.col("term").endswith("*") & (F.col("sure") >= threshold))
    found = found.withColumn("class", F.concat(F.substring("term", 1, 3), F.lit("*"))).join(wide, ["entity", "class"], "left")
    return (
        found.groupBy("term", "class")
        .agg(F.max("disclosure").alias("disclosure"), F.max("wide").alias("wide"))
        .select("term", "disclosure", F.when(F.col("wide") < threshold, F.col("class")).otherwise("[REMOVED]").alias("replacement"))
    )


def _all_spans(text: str, base, terms: dict):
    if not terms or terms.keys().isdisjoint(WORD.findall(text.lower())):
        return base
    found = [(m.start(), 4, m.end()) for m in WORD.finditer(text) if m[0].lower() in terms]
    ends, reach = [s[0] for s in base], []
    far = 0
    for _, _, b in base:
        far = max(far, b)
        reach.append(far)
    free = []
    for a, k, b in found:
        i = bisect_right(ends, b - 1)  # base spans that start before this one ends
        if not i or reach[i - 1] <= a:
            free.append((a, k, b))
    return sorted(base + free)


def _redacted(text: str, spans, terms: dict) -> str:
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], terms[text[a:b].lower()] if k == 4 else f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, min_support: int = 2,
    threshold: float = 0.9, broadcast_terms: int = 200_000, with_text: bool = True,
) -> DataFrame:
    """Find and remove personal data in every whole text.

    Returns all columns of ``docs`` but the text, then n_email, n_ip, n_card, n_phone, n_term, base_spans, spans
    (``kind:start:end`` in code points, end exclusive, by start and then kind) and, with ``with_text``,
    the redacted text. Column names of ``docs`` that clash with these are dropped in their favour. A null
    or empty text has no spans and stays as it is. Repeated rows count as separate documents. Up to
    ``broadcast_terms`` disclosing terms go to every task; more are joined to each document's words.
    """
    new = ["n_email", "n_ip", "n_card", "n_phone", "n_term", "base_spans", "spans"]
    terms = written(disclosing_terms(docs, text_col, window, min_support, threshold), "pii-terms")
    few = terms.limit(broadcast_terms + 1).count() <= broadcast_terms
    table = {r["term"]: r["replacement"] for r in terms.select("term", "replacement").collect()} if few else {}
    keep = [c for c in docs.columns if c != text_col and c.lower() not in new]
    rows = docs.select(*keep, text_col)
    if not few:
        ident, digest, own_terms = (fresh(docs.columns, c) for c in ("_id", "_hash", "_terms"))
        rows = rows.withColumns({ident: F.col(id_col), digest: F.xxhash64(text_col)})

        def words():
            def fn(ids, hashes, texts):
                found = [(i, h, w) for i, h, t in zip(ids, hashes, texts) for w in set(WORD.findall((t or "").lower()))]
                return [x[0] for x in found], [x[1] for x in found], [x[2] for x in found]

            return fn

        kind = docs.schema[id_col].dataType.simpleString()
        said = map_batches(rows.select(ident, digest, text_col), words, f"_id {kind}, _hash bigint, term string")
        said = said.join(terms, "term").groupBy("_id", "_hash").agg(
            F.map_from_entries(F.collect_set(F.struct("term", "replacement"))).alias("_terms")
        )
        rows = rows.alias("r").join(
            said.alias("s"), F.col(f"r.{ident}").eqNullSafe(F.col("s._id")) & F.col(f"r.{digest}").eqNullSafe(F.col("s._hash")), "left"
        ).select(*(f"r.`{c}`" for c in keep), f"r.`{text_col}`", F.col("s._terms").alias(own_terms))
    n = len(keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    schema += ", ".join(f"{c} bigint" for c in new[:5]) + ", base_spans string, spans string"
    schema += f", `{text_col}` string" * with_text

    def make():
        def fn(*cols):
            counts, base_said, said, texts = [[] for _ in range(5)], [], [], []
            for i, text in enumerate(cols[n]):
                own = table if few else dict(cols[n + 1][i] or {})
                base = base_spans(text)
                spans = _all_spans(text, base, own) if text else base
                by = Counter(s[1] for s in spans)
                for k in range(5):
                    counts[k].append(by[k])
                base_said.append(shown(base))
                said.append(shown(spans))
                if with_text:
                    texts.append(_redacted(text, spans, own) if spans else text)
            return [*cols[:n], *counts, base_said, said] + [texts] * with_text

        return fn

    return map_batches(rows, make, schema)


def sha256_text(column):
    return F.sha2(F.coalesce(column, F.lit("")), 256)


def base_digest(text: str | None) -> str:
    """The digest that the query reports for a text's base spans."""
    return hashlib.sha256(shown(base_spans(text)).encode()).hexdigest()
