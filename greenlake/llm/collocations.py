"""Collocations from FM-indexes over word ids.

Each task turns its texts into shards of bounded size, by language: the sequence of word ids, 0 at the ends of pieces,
and from it the Burrows-Wheeler transforms of the sequence and of its reverse. Shards are stored, read again for each
length of phrase, and their counts are summed. Within a shard a phrase is a pair of intervals, one in each transform:
the symbols before its occurrences lie in the first interval, those after them in the second, so counting them
extends the phrase to the left or the right, and ranks of the symbol give the longer phrase's intervals.

Suffixes are sorted by as many words as a phrase may have, which is all that extension up to that depth needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenlake.llm.common import bitmap_of, fresh, map_batches, written
from greenlake.llm.hashing import byte_ranges, pieces

#: Bytes of text in one shard; one piece without a stop may be longer.
SHARD_BYTES = 10 << 20
#: Rows of counts up to which they are broadcast to the phrases.
BROADCAST_ROWS = 500_000
#: A part of phrases is hot from one in so many words on; its phrases are dealt to SALTS tasks.
HOT_SHARE = 2000
SALTS = 64
#: Words themselves are dealt by so many values of their hash.
WORD_SALTS = 4096
#: Bits of the largest bitmap of phrases that may go on.
MAX_BITS = 28

_BYTE = np.arange(256)
_STOP = np.isin(_BYTE, [ord(c) for c in ".,;:!?"]) | ((_BYTE >= 10) & (_BYTE <= 13))
_GAP = _STOP | np.isin(_BYTE, [9, 32])
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)


def words_of(said: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes, number of the piece) of the words of lower-cased bytes."""
    out, stops = [], 0
    for at, part in pieces(said):
        b = np.frombuffer(part, np.uint8)
        word, stop = ~_GAP[b], np.cumsum(_STOP[b])
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out.append((s + at, e + at, byte_ranges(b, s, e), stop[s] + stops))
        stops += int(stop[-1])
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def word_ids(said: bytes) -> tuple[list[str], np.ndarray]:
    """The distinct words, and the ids (from 1) of all words in order with a 0 before, between and after pieces."""
    s, e, h, piece = words_of(said)
    got, first, ids = np.unique(h, return_index=True, return_inverse=True)
    names = [said[a:b].decode() for a, b in zip(s[first].tolist(), e[first].tolist())]
    # Equal hashes must be equal words: a second hash of every word is held against its first occurrence's.
    second = np.concatenate([byte_ranges(_REMIXED[np.frombuffer(p, np.uint8)], *(x[(s >= at) & (s < at + len(p))] - at for x in (s, e))) for at, p in pieces(said)]) if len(s) else h
    if (second != second[first][ids]).any():
        known: dict[str, int] = {}
        ids = np.array([known.setdefault(said[a:b].decode(), len(known)) for a, b in zip(s.tolist(), e.tolist())])
        names = list(known)
    breaks = np.flatnonzero(np.diff(piece, prepend=-1, append=-2))
    return names, np.insert(ids.astype(np.int64) + 1, breaks, 0) if len(ids) else np.zeros(1, np.int64)


_REMIXED = np.random.default_rng(13).permutation(256).astype(np.uint8)


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each suffix of a circular sequence, suffixes in the order of their first ``depth`` symbols."""
    top = int(ids.max()) + 1
    ahead = [np.roll(ids, -k) for k in range(depth)]
    if top**depth < 1 << 63:
        key = ahead[0]
        for x in ahead[1:]:
            key = key * top + x
        order = np.argsort(key)
    else:
        order = np.lexsort(ahead[::-1])
    return ids[order - 1].astype(np.int32)


class Index:
    """Both transforms of a shard, with the places of each symbol in them as rank structure."""

    def __init__(self, left: np.ndarray, right: np.ndarray, n_words: int):
        self.n, self.top = len(left), n_words + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=self.top))])
        self.sides = [left.astype(np.int64), right.astype(np.int64)]
        self._places: list = [None, None]

    def rank(self, side: int, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place of a transform."""
        if self._places[side] is None:
            self._places[side] = np.sort(self.sides[side] * self.n + np.arange(self.n))
        return np.searchsorted(self._places[side], symbol * self.n + place) - self.before[symbol]

    def words(self, alive: np.ndarray):
        """The phrases of one word, for the ids in ``alive``."""
        low = self.before[alive]
        return Phrases(alive[:, None], [low, low.copy()], self.before[alive + 1] - low)


class Phrases:
    """Phrases of one length: their words, the lower ends of their intervals in both transforms, their counts."""

    def __init__(self, words: np.ndarray, low: list[np.ndarray], count: np.ndarray):
        self.words, self.low, self.count = words, low, count

    def take(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.words[keep], [x[keep] for x in self.low], self.count[keep])

    def extend(self, index: Index, side: int, alive: np.ndarray) -> Phrases:
        """All phrases with one more word on the left (side 0) or right (side 1) whose new word is ``alive``."""
        n = len(self.count)
        owner = np.repeat(np.arange(n), self.count)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        symbol = index.sides[side][self.low[side][owner] + within]
        key, count = np.unique(owner * index.top + symbol, return_counts=True)
        owner, symbol = key // index.top, key % index.top
        # Symbols of one phrase stand in order, so those that are smaller come first in the other transform's interval.
        sums = np.cumsum(count) - count
        smaller = sums - sums[np.searchsorted(owner, owner)]
        keep = alive[symbol]
        owner, symbol, count, smaller = owner[keep], symbol[keep], count[keep], smaller[keep]
        low = [None, None]
        low[side] = index.before[symbol] + index.rank(side, symbol, self.low[side][owner])
        low[1 - side] = self.low[1 - side][owner] + smaller
        new = symbol[:, None]
        return Phrases(np.hstack([new, self.words[owner]] if side == 0 else [self.words[owner], new]), low, count)


def build_index(docs: DataFrame, text_col: str, lang_col: str, depth: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored shards: lang, n (word occurrences), words (joined by line ends), left, right (transforms as 32-bit integers)."""

    def make():
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def shards(lang):
            said = _LOWER[np.frombuffer(b"\n".join(held.pop(lang)), np.uint8)].tobytes()
            del size[lang]
            at = 0
            while at < len(said):
                end = min(len(said), at + shard_bytes)
                while end < len(said) and not _STOP[said[end - 1]]:
                    end += 1
                names, ids = word_ids(said[at:end])
                if names:
                    yield lang, int((ids > 0).sum()), "\n".join(names), transform(ids, depth).tobytes(), transform(ids[::-1], depth).tobytes()
                at = end

        def columns(rows):
            rows = list(rows)
            return [list(x) for x in zip(*rows)] if rows else [[]] * 5

        def fn(texts, langs):
            done = []
            for text, lang in zip(texts, langs):
                if text:
                    held.setdefault(lang, []).append(text.encode("utf-8", "replace"))
                    size[lang] = size.get(lang, 0) + len(held[lang][-1]) + 1
                    if size[lang] >= shard_bytes or sum(size.values()) >= 4 * shard_bytes:
                        done += shards(max(size, key=size.get))
            return columns(done)

        return fn, lambda: columns(row for lang in list(held) for row in shards(lang))

    source = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    made = map_batches(source, make, "lang string, n bigint, words string, left binary, right binary")
    return written(made, "fm_index", maxRecordsPerFile=4, compression="zstd")  # a reader holds whole batches of rows


def phrase_counts(index: DataFrame, length: int, seen: list[bytes], bits: list[int], hot: dict[str, list[str]]) -> DataFrame:
    """Rows (base, salt, added) of the phrases of ``length`` words in each shard, by the part they extend.

    ``base`` is language and part, a tab between them. ``added`` holds the new words, joined by line ends, to the right of the part for
    an even length and to its left for an odd one; a tab and the count follow a word unless it is 1. Neither sign is in a word.
    ``seen`` has a bitmap for each shorter length: a phrase is counted only when all its parts may be frequent by it. A base in
    ``hot`` has several rows, by the hash of the new word, so that not all phrases of a very common part come together.
    """
    session = index.sparkSession
    sent = session.sparkContext.broadcast((seen, hot))  # bitmaps of 2**MAX_BITS bits each at most, and HOT_SHARE parts

    def make():
        maps = [np.frombuffer(b, np.uint8) for b in sent.value[0]]
        often = {lang: set(parts) for lang, parts in sent.value[1].items()}

        def may(hashes, level):
            at = np.fromiter(hashes, np.uint64) & np.uint64((1 << bits[level]) - 1)
            return (maps[level][at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

        def of_shard(lang, words, left, right):
            names = words.split("\n")
            index = Index(np.frombuffer(left, np.int32), np.frombuffer(right, np.int32), len(names))
            alive = np.ones(index.top, bool)
            alive[0] = False
            table, raw = pa.array(["", *names]), [b"", *(w.encode() for w in names)]
            seed = xxhash.xxh64_intdigest(lang.encode(), 42)
            first = [0, *(xxhash.xxh64_intdigest(w, seed) for w in raw[1:])]
            if length > 1:
                alive[1:] = may(first[1:], 0)

            def frequent(words, level):
                """Which of these phrases may be frequent, by the chained hash of language and words."""
                h = [first[i] for i in words[:, 0].tolist()]
                for col in words.T[1:]:
                    h = [xxhash.xxh64_intdigest(raw[i], s) for i, s in zip(col.tolist(), h)]
                return may(h, level)

            found = index.words(np.flatnonzero(alive))
            for n in range(2, length + 1):
                found = found.extend(index, n % 2 == 0, alive)
                if n < length:
                    found = found.take(frequent(found.words, n - 1))
                elif n > 2:
                    # The part that was extended is frequent; the one with the new word has to be as well.
                    found = found.take(frequent(found.words[:, 1:] if n % 2 == 0 else found.words[:, :-1], n - 2))
            if not len(found.count):
                return None
            new, rest = (found.words[:, -1], found.words[:, :-1]) if length % 2 == 0 else (found.words[:, 0], found.words[:, 1:])
            parts = [table.take(pa.array(c)) for c in rest.T]
            base = pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0] if parts else pa.repeat(pa.scalar(""), len(new))
            hashed = np.array(first, np.uint64)[new]
            if length == 1:
                salt = hashed % np.uint64(WORD_SALTS)
            else:
                common = pc.is_in(base, pa.array(sorted(often.get(lang, ())), pa.string())).to_numpy(zero_copy_only=False)
                salt = np.where(common, hashed % np.uint64(SALTS), np.uint64(0))
            key = np.column_stack([rest, salt.astype(np.int64)])
            order = np.lexsort(key.T[::-1])
            key = key[order]
            starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
            return base.take(pa.array(order[starts])), key[starts, -1], table.take(pa.array(new[order])), found.count[order], np.append(starts, len(new))

        def fn(langs, *shards):
            out = [[] for _ in range(3)]
            for lang, *shard in zip(langs, *shards):
                if (made := of_shard(lang, *shard)) is None:
                    continue
                base, salt, added, count, ends = made
                counted = pc.binary_join_element_wise(added, pa.array(count).cast(pa.string()), "\t")
                entries = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.if_else(pa.array(count == 1), added, counted))
                columns = pc.binary_join_element_wise(pa.scalar(lang), base, "\t"), pa.array(salt.astype(np.int32)), pc.binary_join(entries, "\n")
                for kept, c in zip(out, columns):
                    kept.append(c)
            return [pa.concat_arrays(c) if c else [] for c in out]

        return fn

    return map_batches(index.select("lang", "words", "left", "right"), make, "base string, salt int, added string")


def _frequent(index: DataFrame, length: int, least: int, seen: list[bytes], bits: list[int], hot: dict[str, list[str]]) -> DataFrame:
    """Stored rows (lang, phrase, a) of the phrases of ``length`` words with at least ``least`` occurrences."""
    dealt = phrase_counts(index, length, seen, bits, hot).repartition("base", "salt")
    each = dealt.select("base", "salt", F.explode(F.split("added", "\n")).alias("entry"))
    each = each.select("base", "salt", F.substring_index("entry", "\t", 1).alias("word"), F.when(F.contains("entry", F.lit("\t")), F.substring_index("entry", "\t", -1).cast("long")).otherwise(1).alias("n"))
    # Dealt by a part of the key already, so the sums need no other exchange.
    summed = each.groupBy("base", "salt", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    summed = summed.withColumns({"lang": F.regexp_extract("base", "(?s)^(.*)\t", 1), "base": F.substring_index("base", "\t", -1)})  # a language may hold a tab, a phrase may not
    parts = ["word"] if length == 1 else ["base", "word"] if length % 2 == 0 else ["word", "base"]
    return written(summed.select("lang", F.concat_ws(" ", *parts).alias("phrase"), "a"), f"phrases{length}")


def _looked_up(rows: DataFrame, key: str, counts: DataFrame, n_counts: int, name: str, broadcast_rows: int) -> DataFrame:
    """``rows`` with the count of the phrase in column ``key``; of a very common one the adaptive join splits the rows."""
    side = counts.select(F.col("lang"), F.col("phrase").alias(key), F.col("a").alias(name))
    return rows.join(F.broadcast(side) if n_counts <= broadcast_rows else side, ["lang", key])


def _ranked(rows: DataFrame, group: str, order: list, top: int, broadcast_rows: int) -> DataFrame:
    """The first ``top`` rows of each group with their rank, by a sort in ranges, so a group with a third of all rows is cut over tasks."""
    at = fresh(rows.columns, "_at")
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(at, 33).alias("_part")  # the upper bits of such an id are its task's number
    parts = dealt.groupBy(group, part).agg(F.min(at).alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = written(parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).where(F.col("_before") < top), "ranked_parts")
    side = F.broadcast(parts) if parts.count() <= broadcast_rows else parts  # groups and tasks together
    ranked = dealt.withColumn("_part", part).join(side, [group, "_part"])
    return ranked.withColumn("rank", F.col("_before") + F.col(at) - F.col("_first") + 1).where(F.col("rank") <= top).select(*rows.columns, "rank")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, min_count: int = 10, contained_percent: int = 50,
    top: int = 2000, shard_bytes: int = SHARD_BYTES, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """The phrases of 2 to ``max_words`` words of each language that stick together most.

    A phrase's score is ``floor(1000000 * a * a / (l * r))`` for its own count ``a`` and the counts of the two parts of
    its weakest cut. Phrases with a longer one around them that has ``contained_percent`` of their count are dropped. Returns
    lang, rank (from 1), phrase, a, l, r, n (the language's words), score: the first ``top`` of each language by score,
    then count, both falling, then phrase.

    A null text has no words; a null language counts as ``und``, together with a language of that name. Repeated rows
    count as often as they stand; other columns are not read; an empty table gives an empty one. All counts are over all
    texts: a phrase can only be frequent when its parts are, so lengths are counted one after the other, and bitmaps of
    the parts that passed keep most others from being summed; a bit that is set by chance costs a row and changes nothing.
    """
    index = build_index(docs, text_col, lang_col, max_words, shard_bytes)
    total = index.groupBy("lang").agg(F.sum("n").alias("n"))
    n_words = index.agg(F.sum("n")).first()[0] or 0
    levels, sizes, seen, bits, hot = [], [], [], [], {}
    for length in range(1, max_words + 1):
        levels.append(_frequent(index, length, min_count, seen, bits, hot))
        sizes.append(levels[-1].count())
        hot = {}
        for r in levels[-1].where(F.col("a") * HOT_SHARE >= n_words).collect():  # HOT_SHARE of each length at most
            hot.setdefault(r["lang"], []).append(r["phrase"])
        if length < max_words:
            bits.append(min(MAX_BITS, max(20, (16 * sizes[-1]).bit_length())))
            words = F.split("phrase", " ")
            name = F.xxhash64("lang", *(words[i] for i in range(length)))
            seen.append(bitmap_of(levels[-1].select(name.alias("h")), "h", bits[-1]))
    scored = []
    for length in range(2, max_words + 1):
        rows, words, cuts = levels[length - 1], F.split("phrase", " "), []
        for k in range(1, length):
            rows = rows.withColumn("_l", F.array_join(F.slice(words, 1, k), " ")).withColumn("_r", F.array_join(F.slice(words, k + 1, length - k), " "))
            rows = _looked_up(rows, "_l", levels[k - 1], sizes[k - 1], f"l{k}", broadcast_rows)
            rows = _looked_up(rows, "_r", levels[length - k - 1], sizes[length - k - 1], f"r{k}", broadcast_rows).drop("_l", "_r")
            wide = lambda c: f"CAST({c} AS DECIMAL(38,0))"
            score = F.expr(f"({wide('a')} * {wide('a')} * 1000000BD) DIV ({wide(f'l{k}')} * {wide(f'r{k}')})")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        rows = rows.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0]).select("lang", "phrase", "a", "cut")
        if length < max_words:
            # A phrase inside a longer one lies inside one that is a word longer and at least as frequent.
            longer = F.split("phrase", " ")
            parts = F.array_distinct(F.array(F.array_join(F.slice(longer, 1, length), " "), F.array_join(F.slice(longer, 2, length), " ")))
            around = levels[length].select("lang", F.explode(parts).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_around"))
            rows = rows.join(around, ["lang", "phrase"], "left").where("_around IS NULL OR 100 * _around < %d * a" % contained_percent).drop("_around")
        scored.append(rows)
    rows = scored[0]
    for more in scored[1:]:
        rows = rows.unionByName(more)
    rows = rows.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    best = ["lang", F.col("score").desc(), F.col("a").desc(), "phrase"]
    first = _ranked(rows, "lang", best, top, broadcast_rows)
    return first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
