"""Language identification by rank-order n-gram profiles and the out-of-place distance."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenlake.llm.common import map_batches

PROFILE = 400
_OTHER_LETTER = 0xF8FF  # stands for letters beyond the basic plane
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point to lower-cased letter, 0 for anything else."""
    if not _TABLE:
        table = np.zeros(1 << 16, np.uint64)
        for c in range(1 << 16):
            if (ch := chr(c)).isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
        _TABLE.append(table)
    return _TABLE[0]


def letters_of(text: str) -> np.ndarray:
    """A text's letters with one 0 between words and at both ends; empty without letters."""
    at = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    x = _letters()[np.minimum(at, 0xFFFF)]
    for i in np.nonzero(at > 0xFFFF)[0]:
        x[i] = _OTHER_LETTER if chr(at[i]).isalpha() else 0
    x = np.concatenate([np.zeros(1, np.uint64), x, np.zeros(1, np.uint64)])
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
    return x if len(x) > 1 else x[:0]


def grams(x: np.ndarray) -> np.ndarray:
    """Codes of the 1-, 2- and 3-grams of words with a blank at either end."""
    two = (x[:-1] << np.uint64(16)) | x[1:]
    mid = x[1:-1] != 0
    three = (x[:-2] << np.uint64(32)) | (x[1:-1] << np.uint64(16)) | x[2:]
    return np.concatenate([x[x != 0], two | np.uint64(1 << 48), three[mid] | np.uint64(1 << 49)])


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    got, n = np.unique(codes, return_counts=True)
    return got[np.lexsort((got, -n))[:size]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, salts: int = 16) -> DataFrame:
    """Rows (lang, code, rank) of each language's ``size`` most frequent n-grams over all of ``docs``.

    Rows with a null text or language teach nothing. The top list is taken within salts first, so no task
    holds all n-grams of a language.
    """

    def make():
        def fn(texts, langs):
            out = ([], [], [])
            for lang in sorted({g for g in langs if g is not None}):
                own = [letters_of(t) for t, g in zip(texts, langs) if g == lang and t]
                at = 0
                while at < len(own):  # about a million characters at a time
                    part, n = [], 0
                    while at < len(own) and n < 1 << 20:
                        part.append(own[at])
                        n += len(own[at])
                        at += 1
                    if n:
                        got, count = np.unique(grams(np.concatenate(part)), return_counts=True)
                        out[0].extend([lang] * len(got))
                        out[1].extend(got.astype(np.int64).tolist())
                        out[2].extend(count.tolist())
            return out

        return fn

    n = map_batches(docs.select(text_col, lang_col), make, "lang string, code bigint, n bigint")
    n = n.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("salt", F.pmod(F.xxhash64("code"), F.lit(salts)))
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(F.desc("n"), "code"))
    top = n.withColumn("rank", first).where(F.col("rank") <= size)
    last = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return top.withColumn("rank", last).where(F.col("rank") <= size).select("lang", "code", (F.col("rank") - 1).alias("rank"))


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """The nearest profile for every row: id, lang_pred and score, 1 less the distance's share of its maximum.

    ``und`` with score 0 for a null text, a text without letters, or when nothing was learned. Equal
    distances go to the first language by name. The profiles, ``size`` rows a language, go to every task.
    Repeated rows and null ids keep one output row each; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    learned: dict[str, list] = {}
    for r in profiles.orderBy("lang", "code").collect():
        learned.setdefault(r["lang"], []).append((r["code"], r["rank"]))

    def make():
        names = sorted(learned)
        tables = [(np.array([c for c, _ in learned[g]], np.uint64), np.array([r for _, r in learned[g]], np.int64)) for g in names]

        def fn(ids, texts):
            best, scores = [], []
            for text in texts:
                x = letters_of(text) if text else ()
                if not len(x) or not names:
                    best.append("und")
                    scores.append(0.0)
                    continue
                own = ranked(grams(x), size)
                rank = np.arange(len(own))
                far = []
                for codes, ranks in tables:
                    at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                    far.append(int(np.where(codes[at] == own, np.abs(ranks[at] - rank), size).sum()))
                i = int(np.argmin(far))
                best.append(names[i])
                scores.append(1.0 - far[i] / (size * len(own)))
            return ids, best, scores

        return fn

    return map_batches(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, lang_pred string, score double")
