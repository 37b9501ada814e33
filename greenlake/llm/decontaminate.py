"""Benchmark decontamination by spaced-seed hashing (DataFrame functions only).

A seed is a fixed mask over consecutive words whose zeros are ignored. For each compared width the masks are chosen
so that every way in which the allowed share of words may differ leaves all selected words of some mask at
some position alike. Items and documents are hashed by these masks at every position, so no alignment that
passes is without a hit; each hit's alignment is then verified word by word. Seeds that many items share count
only with a rare word beside them or with enough words that the items share too.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlake.llm.common import fresh, written

#: Shorter items must agree in every word.
LEAST = 7
#: Masks by the fewest words compared; tests try every pattern of differences at 80 percent.
MASKS = ((15, ("111011", "11111")), (10, ("11101", "1111")), (LEAST, ("11011",)))
#: Positions of a text's words whose places go together in one row.
BLOCK = 4096


def needed(width: int, similarity: float) -> int:
    return width if width < LEAST else math.ceil(width * similarity)


def always_hit(masks: tuple[str, ...], width: int, need: int) -> bool:
    """Whether every choice of ``width - need`` differing words leaves some mask's words alike."""
    placed = [{at + i for i, c in enumerate(m) if c == "1"} for m in masks for at in range(width - len(m) + 1)]
    return all(any(p.isdisjoint(off) for p in placed) for off in combinations(range(width), width - need))


def families(overlap: int, similarity: float) -> dict[tuple[str, ...], list[int]]:
    """Compared widths by the masks that serve them; where the fixed ones don't, a run that must agree by pigeonhole."""
    out: dict[tuple[str, ...], list[int]] = {}
    for width in range(1, overlap + 1):
        need = needed(width, similarity)
        masks = next((m for least, m in MASKS if width >= least), ())
        few = math.comb(width, need) <= 5000
        if need == width:
            masks = ("1" * width,)
        elif not masks or not few or not always_hit(masks, width, need):
            masks = ("1" * max(1, math.ceil(need / (width - need + 1))),)
        out.setdefault(masks, []).append(width)
    return out


def words(text) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def word_hashes(text) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _seeds(hashes: str, masks: tuple[str, ...]) -> Column:
    """(position, hash) of the words that each mask selects from every position."""
    def of(mask):
        at = [k for k, c in enumerate(mask) if c == "1"]
        starts = F.sequence(F.lit(0), F.size(hashes) - len(mask))
        made = F.transform(starts, lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(mask), *(F.get(hashes, i + k) for k in at)).alias("seed")))
        return F.when(F.size(hashes) >= len(mask), made).otherwise(F.expr("cast(array() as array<struct<at: int, seed: bigint>>)"))

    return of(masks[0]) if len(masks) == 1 else F.concat(*map(of, masks))


def _said(d: DataFrame, wanted: DataFrame, more: list[str], broadcast_hits: int) -> DataFrame:
    """``wanted`` (id, text_hash, start, n, ``more``) with ``said``, the documents' words from ``start`` on, null outside the text.

    Each text is split once for all its places, which are gathered by blocks of its words, so a row never holds more than those of one block.
    """
    block = F.floor(F.greatest("start", F.lit(0)) / BLOCK).cast("int").alias("block")
    lists = wanted.groupBy("id", "text_hash", block).agg(F.collect_set(F.struct("start", "n", *more)).alias("wants"))
    lists = written(lists.groupBy("id", "text_hash").agg(F.collect_list(F.struct("block", "wants")).alias("blocks")), "places")
    places = F.aggregate("blocks", F.lit(4), lambda a, x: a + F.size(x["wants"]))
    if (lists.agg(F.sum(places)).first()[0] or 0) <= broadcast_hits * 5:
        lists = F.broadcast(lists)  # then no text is shuffled
    at = d.alias("d").join(lists.alias("h"), F.expr("d.id <=> h.id and d.text_hash = h.text_hash"))
    at = at.select("d.id", "d.text_hash", "h.blocks", word_hashes(F.col("d.body")).alias("hashes"))
    part = F.transform("blocks", lambda x: F.struct(
        x["wants"].alias("wants"), (x["block"] * BLOCK).alias("base"),
        F.slice("hashes", x["block"] * BLOCK + 1, BLOCK + F.array_max(F.transform(x["wants"], lambda w: w["n"]))).alias("words"),
    ))
    at = at.select("id", "text_hash", F.explode(part).alias("p")).select("id", "text_hash", "p.wants", "p.base", "p.words")
    said = F.transform("wants", lambda w: F.struct(
        *(w[c].alias(c) for c in ("start", "n", *more)),
        F.transform(F.sequence(F.lit(0), w["n"] - 1), lambda k: F.get("words", w["start"] + k - F.col("base"))).alias("said"),
    ))
    return at.select("id", "text_hash", F.explode(said).alias("a")).select("id", "text_hash", "a.*")


def _past_common_seeds(d: DataFrame, places: DataFrame, seeds: DataFrame, items: DataFrame, overlap: int, need: Column, most: int, broadcast_hits: int) -> DataFrame:
    """Alignments (id, text_hash, item, n_words, shift) worth verifying at places (id, text_hash, seed, at) of seeds that many items share.

    Of the words around such a seed in the items, those on more than ``most`` items at one distance are common, the
    others rare. An alignment that passes agrees in a rare word, whose items are few, or in enough common words. Items
    that are alike in all common words are one class, and a place is compared with classes, so an opening that a thousand items
    share costs one comparison at each of its places, not a thousand.
    """
    reach = overlap - 1
    near = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda o: F.get("i_hashes", F.col("j") + o))
    own = seeds.join(items, ["item", "n_words"]).select("seed", "item", "n_words", "j", need.alias("need"), near.alias("near"))
    own = own.select("seed", "item", "n_words", "j", "need", F.posexplode("near").alias("o", "word")).where("word is not null")
    often = own.groupBy("seed", "o", "word").agg(F.count("*").alias("times")).where(F.col("times") > most).select("seed", "o", "word", F.lit(True).alias("common"))
    own = written(own.join(often, ["seed", "o", "word"], "left"), "words-at-common-seeds")
    rare = own.where("common is null").select("seed", "o", "word", "item", "n_words", "j")
    # The seed's own words are common, so every row has a class.
    alike = own.where("common").groupBy("seed", "item", "n_words", "j", "need").agg(F.sort_array(F.collect_list(F.struct("o", "word"))).alias("words"))
    alike = written(alike.withColumn("class", F.xxhash64("need", "words")), "classes-at-common-seeds")
    classes = alike.select("seed", "class", "need", "words").distinct()
    wanted = places.select("id", "text_hash", (F.col("at") - reach).alias("start"), F.lit(2 * reach + 1).alias("n"), "seed")
    said = written(_said(d, wanted, ["seed"], broadcast_hits).withColumn("at", F.col("start") + reach), "words-at-places")
    there = said.select("id", "text_hash", "at", "seed", F.posexplode("said").alias("o", "word")).where("word is not null")
    by_rare = there.join(rare, ["seed", "o", "word"])
    same = F.transform(F.filter("words", lambda w: F.get("said", w["o"]) == w["word"]), lambda w: w["o"])
    within = F.transform("same", lambda a: F.size(F.filter("same", lambda b: (b >= a) & (b < a + overlap))))
    by_common = said.join(classes, "seed").select("id", "text_hash", "at", "seed", "class", "need", same.alias("same"))
    by_common = by_common.where(F.array_max(within) >= F.col("need")).join(alike.select("seed", "class", "item", "n_words", "j"), ["seed", "class"])
    out = ("id", "text_hash", "item", "n_words", (F.col("at") - F.col("j")).alias("shift"))
    return by_rare.select(*out).unionByName(by_common.select(*out))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", overlap: int = 20, similarity: float = 0.8, broadcast_seeds: int = 1_000_000,
    broadcast_hits: int = 100_000, common_seed: int = 64,
) -> DataFrame:
    """Rows (id, text_hash, item, n_match, n_words, doc_word) of documents that hold benchmark text.

    A document holds an item when, on one alignment, some ``overlap`` consecutive words of the item (all
    of a shorter one) agree in at least the share ``similarity`` of positions, and in all of them for items of
    under 7 words; an item of one word is thus held wherever that word stands. n_match is the most agreeing words on an alignment, n_words the
    item's length and doc_word the first such alignment's position in the document's words, 0 where it begins before them. Null or
    empty texts and items hold nothing; repeated rows give one row; null ids are kept apart by their
    text; other columns are not read. Texts are split and hashed by all masks in one pass. The seeds of the benchmark are broadcast up to
    ``broadcast_seeds`` rows and joined by shuffle beyond; so are the documents with hits, up to
    ``broadcast_hits`` of them with one alignment each or fewer with more, when their texts are fetched again.
    Seeds at more than ``common_seed`` places of items make no alignments by themselves: see :func:`_past_common_seeds`. The
    rows are the same whatever these three are.
    """
    items = benchmark.where(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).alias("item"), word_hashes(F.col(item_text_col)).alias("i_hashes")
    )
    items = items.withColumn("n_words", F.size("i_hashes")).where("n_words > 0").distinct()
    d = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("body")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    width = F.least(F.lit(overlap), F.col("n_words"))
    need = F.when(width < LEAST, width).otherwise(F.ceil(width * similarity))
    present = {r[0] for r in items.select(width).distinct().collect()}  # at most ``overlap`` values
    served = {masks: widths for masks, widths in families(overlap, similarity).items() if not present.isdisjoint(widths)}
    if served:
        of_item = F.coalesce(*(F.when(width.isin(widths), _seeds("i_hashes", masks)) for masks, widths in served.items()))
        seeds = items.select("item", "n_words", F.explode(of_item).alias("s"))
        seeds = written(seeds.select("item", "n_words", F.col("s.at").alias("j"), F.col("s.seed").alias("seed")), "benchmark-seeds")
        common = written(seeds.groupBy("seed").agg(F.count("*").alias("times")).where(F.col("times") > common_seed).select("seed"), "common-seeds")
        known = seeds.join(common, "seed", "left_anti").unionByName(common, allowMissingColumns=True)
        known = F.broadcast(known) if seeds.limit(broadcast_seeds + 1).count() <= broadcast_seeds else known
        masks = tuple(m for some in served for m in some)
        x = d.select("id", "text_hash", word_hashes(F.col("body")).alias("hashes"))
        x = x.select("id", "text_hash", F.explode(_seeds("hashes", masks)).alias("s")).select("id", "text_hash", "s.at", "s.seed")
        alone = F.col("j").isNotNull()
        found = x.join(known, "seed").select(
            "id", "text_hash", "item", "n_words", (F.col("at") - F.col("j")).alias("shift"),
            F.when(~alone, F.col("seed")).alias("seed"), F.when(~alone, F.col("at")).alias("at"),
        )
        found = written(found.groupBy(*found.columns).agg(F.lit(1).alias("_")), "seed-hits")
        hits = found.where("seed is null").select("id", "text_hash", "item", "n_words", "shift")
        places = found.where("seed is not null").select("id", "text_hash", "seed", "at")
        if common.limit(1).count() and places.limit(1).count():
            past = _past_common_seeds(d, places, seeds.join(common, "seed", "left_semi"), items, overlap, need, common_seed, broadcast_hits)
            hits = written(hits.unionByName(past).distinct(), "alignments")
    else:
        hits = d.where("false").join(items.where("false"), F.lit(True)).select("id", "text_hash", "item", "n_words", F.lit(0).alias("shift"))
    at = _said(d, hits.select("id", "text_hash", F.col("shift").alias("start"), F.col("n_words").alias("n")), [], broadcast_hits)
    few = hits.limit(broadcast_hits + 1).count() <= broadcast_hits
    at = at.alias("a").join((F.broadcast(hits) if few else hits).alias("h"), F.expr("a.id <=> h.id and a.text_hash = h.text_hash and start = shift and n = n_words"))
    at = at.select("a.id", "a.text_hash", "item", "n_words", "shift", "said").join(items, ["item", "n_words"])
    at = at.withColumn("same", F.zip_with("said", "i_hashes", lambda a, b: F.when(a == b, 1).otherwise(0)))
    runs = F.transform(
        F.sequence(F.lit(1), F.col("n_words") - width + 1),
        lambda s: F.aggregate(F.slice("same", s, width), F.lit(0), lambda a, b: a + b),
    )
    at = at.where(F.array_max(runs) >= need)
    total = F.aggregate("same", F.lit(0), lambda a, b: a + b)
    return (
        at.groupBy("id", "text_hash", "item")
        .agg(F.max(total).cast("long").alias("n_match"), F.first("n_words").cast("long").alias("n_words"), F.min(F.greatest("shift", F.lit(0))).cast("long").alias("doc_word"))
        .select(F.col("id").cast(kind).alias(id_col), "text_hash", F.col("item").alias(item_col), "n_match", "n_words", "doc_word")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark text, with all their columns; null texts stay."""
    ident, digest = fresh(docs.columns, "_b"), fresh(docs.columns, "_h")
    bad = contaminated(docs, benchmark, id_col, text_col, **options).select(F.col(id_col).alias(ident), F.col("text_hash").alias(digest)).distinct()
    bad, most = written(bad, "contaminated"), options.get("broadcast_hits", 100_000)
    bad = F.broadcast(bad) if bad.limit(most + 1).count() <= most else bad
    return docs.join(bad, docs[id_col].eqNullSafe(bad[ident]) & (F.xxhash64(docs[text_col]) == bad[digest]), "left_anti")
