"""Substring dedup by sliding sentence spans.

Sentences end at ``.``, ``!``, ``?`` or a line end; a sentence of more than ``piece_words`` words counts as
consecutive pieces of at most so many, cut after the word of smallest hash in each window of
``piece_words // 2 + 1`` words, so equal passages are cut alike wherever their sentences begin. Spans run from
every sentence and, with ``both_ends``, up to every sentence over several consecutive ones, as few as reach ``min_words``: both
together cover every repeated run of sentences that is long enough. Spans are hashed and joined over the whole
corpus; in order of document id and position, sentences that any span but the first of its kind covers are removed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.llm.common import bitmap_of, fresh, map_batches, written
from greenlake.llm.hashing import SPACE, byte_ranges, mix, pieces, ranges, running

_STOP = np.isin(np.arange(256), [ord(c) for c in ".!?"])


class Parts(NamedTuple):
    """A text's parts: its bytes, where each part begins and ends in them, the first word of each and the number of words, words' hashes."""

    said: bytes
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def _words(low: bytes):
    """(start, end, hash, whether a sentence begins) of all words, and the places after which sentences end."""
    out, stops = [], []
    for at, piece in pieces(low):
        b = np.frombuffer(piece, np.uint8)
        stop, word = _STOP[b], ~SPACE[b]
        over = np.zeros(len(b) + 1, bool)  # a sentence ends before this place
        over[1:] = b == 10
        over[1:] |= stop & ~np.append(stop[1:], False)
        start = word.copy()
        start[1:] &= SPACE[b[:-1]] | over[1:-1]
        end = word.copy()
        end[:-1] &= SPACE[b[1:]] | over[1:-1]
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        out.append((s + at, e + at, byte_ranges(b, s, e)))
        stops.append(np.flatnonzero(over) + at)
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out)) + (np.concatenate(stops),)


def parts_of(text: str | None, piece_words: int = 16) -> Parts:
    """Sentences of a text that hold a word, long ones cut into pieces.

    Words are told apart by ASCII white space and compared in lower case.
    """
    said = (text or "").encode("utf-8", "replace")
    low = (text or "").lower().encode("utf-8", "replace")
    s, e, h, stops = _words(low if len(low) == len(said) else said.lower())
    bounds = np.concatenate([[0], stops, [len(said)]])
    sentence = np.searchsorted(stops, s, "right")
    new = np.ones(len(s) + 1, bool)
    new[1:-1] = sentence[1:] != sentence[:-1]
    heads, window = new.copy(), piece_words // 2 + 1
    long = np.repeat(np.diff(np.flatnonzero(heads)) > piece_words, np.diff(np.flatnonzero(heads)))
    if long.any():
        # Long sentences are cut after the last word of smallest hash in each window.
        back = sliding_window_view(h[::-1], window).argmin(1)
        cut = len(s) - (np.arange(len(back)) + back)
        head = len(s) - window - np.arange(len(back))
        cut = cut[long[head] & (sentence[head] == sentence[head + window - 1])]
        new[cut] = True
    first = np.flatnonzero(new)
    begin, end = s[first[:-1]], e[first[1:] - 1]
    lead, tail = heads[first[:-1]], heads[first[1:]]
    begin[lead] = bounds[np.searchsorted(bounds, begin[lead], "right") - 1]
    end[tail] = bounds[np.searchsorted(bounds, end[tail], "left")]
    return Parts(said, begin, end, first, h, s, e)


def sentences(text: str | None, piece_words: int = 16) -> list[tuple[int, int, str, int]]:
    """(begin, end, normal form, words) of a text's parts; places count bytes."""
    p = parts_of(text, piece_words)
    out = []
    for k in range(len(p.begin)):
        words = [p.said[p.starts[i] : p.ends[i]].decode().lower() for i in range(p.first[k], p.first[k + 1])]
        out.append((int(p.begin[k]), int(p.end[k]), " ".join(words), len(words)))
    return out


def spans(p: Parts, min_sentences: int = 3, min_words: int = 24, both_ends: bool = False):
    """(first part, parts, hash) as arrays of the shortest spans from each part, and with ``both_ends`` up to each, where the text is long enough."""
    first, n = p.first, len(p.begin)
    start = np.arange(n)
    end = np.maximum(start + min_sentences, np.searchsorted(first, first[:-1] + min_words, "left"))
    start, end = start[end <= n], end[end <= n]
    if both_ends:
        last = np.arange(1, n + 1)
        from_ = np.minimum(last - min_sentences, np.searchsorted(first, first[1:] - min_words, "right") - 1)
        last, from_ = last[from_ >= 0], from_[from_ >= 0]
        pair = np.unique(np.concatenate([start, from_]) * (n + 1) + np.concatenate([end, last]))
        start, end = pair // (n + 1), pair % (n + 1)
    names = ranges(running(mix(p.words)), first[:-1], first[1:])  # a span's hash is that of its parts' hashes
    return start, end - start, ranges(running(names), start, end).view(np.int64)


def repeated_sentences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_sentences: int = 3, min_words: int = 24, piece_words: int = 16,
    both_ends: bool = False, bits: int = 30,
) -> DataFrame:
    """Rows (id, text_hash, removed) of the documents that lose sentences, with their sentence numbers from 0, sorted.

    The first of equal spans is the one with the smallest id, then position; rows with null ids come
    last. Rows that share an id are told apart by the hash of their text; those that share both count as one
    document. Null, empty and short texts have no
    span. Other columns are not read. A span on very many documents is counted by a partial aggregate. A bitmap of
    the repeated spans, 16 bits or more for each, then tells which spans are worth a row; where it would take more than
    ``2**bits`` bits every span gets one. Firsts and their repeats are written before they are joined by hash, so
    the adaptive skew join can split a span on very many documents; only the numbers of one document's sentences are ever gathered.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    options = (min_sentences, min_words, both_ends)

    def names():
        return lambda texts: [np.concatenate([np.zeros(0, np.int64), *(spans(parts_of(t, piece_words), *options)[2] for t in texts)])]

    counted = map_batches(docs.select(text_col), names, "span bigint").groupBy("span").agg(F.count("*").alias("times"))
    repeated = written(counted.where("times > 1").select("span"), "repeated-spans")
    size = max(16, (16 * repeated.count()).bit_length())
    sent = docs.sparkSession.sparkContext.broadcast(bitmap_of(repeated, "span", size) if size <= bits else b"")

    def make():
        table = np.frombuffer(sent.value, np.uint8)

        def fn(ids, hashes, texts):
            out = ([], [], [], [], [])
            for i, key, text in zip(ids, hashes, texts):
                at, n, h = spans(parts_of(text, piece_words), *options)
                if len(table):
                    place = h & ((1 << size) - 1)
                    some = (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                    at, n, h = at[some], n[some], h[some]
                for column, x in zip(out, ([i] * len(at), [key] * len(at), at, n, h)):
                    column.append(x)
            ids, hashes = ([v for part in column for v in part] for column in out[:2])
            return ids, hashes, *(np.concatenate([np.zeros(0, np.int64), *column]) for column in out[2:])

        return fn

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), text_col)
    found = written(map_batches(rows, make, f"id {kind}, text_hash bigint, at int, n int, span bigint"), "sentence-spans")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "at")
    first = found.groupBy("span").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    later = found.join(written(first, "first-spans"), "span").where(~place.eqNullSafe(F.col("first"))).drop("first")
    covered = later.select("id", "text_hash", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("at"))
    gone = covered.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("removed"))
    return gone.select(F.col("id").alias(id_col), "text_hash", "removed")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", only_changed: bool = False, **options) -> DataFrame:
    """All columns of ``docs`` with the repeated sentences cut from the text, plus n_sentences and n_removed.

    Existing columns of those two names are replaced. Documents without repeats keep their text as it is;
    with ``only_changed`` they are left out. Spans run from and up to every sentence. See :func:`repeated_sentences`.
    """
    piece_words = options.get("piece_words", 16)
    ident, digest, cut = (fresh(docs.columns, c) for c in ("_id", "_hash", "_removed"))
    gone = repeated_sentences(docs, id_col, text_col, **{"both_ends": True} | options)
    gone = gone.select(F.col(id_col).alias(ident), F.col("text_hash").alias(digest), F.col("removed").alias(cut))
    keep = [c for c in docs.columns if c.lower() not in ("n_sentences", "n_removed")]
    same = F.col(id_col).eqNullSafe(F.col(ident)) & (F.xxhash64(text_col) == F.col(digest))
    rows = docs.select(*keep).join(gone, same, "inner" if only_changed else "left").select(*keep, cut)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema) + "n_sentences bigint, n_removed bigint"
    at = keep.index(text_col)

    def make():
        def fn(*cols):
            *cols, removed = cols
            texts, total, lost = [], [], []
            for text, numbers in zip(cols[at], removed):
                p = parts_of(text, piece_words)
                out, last = [], 0
                cut = [k for k in numbers or () if k < len(p.begin)]
                for k in cut:
                    out.append(p.said[last : p.begin[k]])
                    last = p.end[k]
                texts.append(b"".join([*out, p.said[last:]]).decode() if cut else text)
                total.append(len(p.begin))
                lost.append(len(cut))
            cols[at] = texts
            return [*cols, total, lost]

        return fn

    return map_batches(rows, make, schema)
