import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from greenlake.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, phrase string, a string"


def grams(rows, most):
    """Counts of all phrases up to ``most`` words, by language."""
    counts = {}
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            for n in range(1, most + 1):
                counts.setdefault(lang if lang is not None else "und", Counter()).update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))
    return counts


def brute(rows, most=3, least=10, percent=50, top=2000):
    out = []
    for lang, f in grams(rows, most).items():
        total, found = sum(v for p, v in f.items() if " " not in p), []
        cands = {p: v for p, v in f.items() if " " in p and v >= least}
        for p, a in cands.items():
            if any(f" {p} " in f" {q} " and q != p and 100 * b >= percent * a for q, b in cands.items()):
                continue
            w = p.split(" ")
            cuts = [(f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
            score, k = min((Fraction(10**6 * a * a, x * y).__floor__(), k) for k, (x, y) in enumerate(cuts))
            found.append((-score, -a, p.encode(), *cuts[k]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total, -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out)


def texts(seed, n, vocabulary):
    rnd = random.Random(seed)
    for _ in range(n):
        said = "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rnd.randrange(0, 60)))
        yield said, rnd.choice(["en", "fr", None, "und", ""])


@pytest.mark.parametrize("shard,broadcast,most", [(400, 0, 3), (1 << 20, 10**6, 3), (150, 0, 4), (2000, 10**6, 2)])
def test_against_counting_all_phrases(frame, shard, broadcast, most):
    rows = list(texts(1, 150, ["The", "the", "cat", "sat", "é", "日本", "on", "a-b", "x1"])) + [(None, "en"), ("", "en"), ("New York city " * 30, "en"), ("New York city " * 30, "en"), ("alone", "de")]
    rows += [("word " * 3000 + "end", "long")]
    docs = frame([(i, t, lang, "clash", "clash") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    got = co.collocations(docs, max_words=most, min_count=5, top=40, shard_bytes=shard, broadcast_rows=broadcast)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, most, 5, 50, 40)


def test_empty_tables(frame):
    assert co.collocations(frame([], SCHEMA)).count() == 0
    assert co.collocations(frame([(1, None, "en", None, None), (2, " .. ", None, None, None)], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", ".", "!"]), max_size=60), st.integers(2, 4))
def test_intervals_of_the_index(symbols, depth):
    names, ids = co.word_ids(" ".join(symbols).encode())
    if not names:
        return
    index = co.Index(co.transform(ids, depth), co.transform(ids[::-1], depth), len(names))
    alive = np.ones(index.top, bool)
    alive[0] = False
    want = grams([(" ".join(symbols), "x")], depth)["x"]
    for first_side in (0, 1):  # any order of left and right steps gives the same phrases
        found = index.words(np.flatnonzero(alive))
        for n in range(2, depth + 1):
            found = found.extend(index, (n + first_side) % 2, alive)
            got = {" ".join(names[i - 1] for i in w): c for w, c in zip(found.words.tolist(), found.count.tolist())}
            assert got == {p: c for p, c in want.items() if p.count(" ") == n - 1}


def test_equal_hashes_are_told_apart(monkeypatch):
    real = co.byte_ranges
    calls = []

    def weak(b, s, e):
        calls.append(1)
        return real(b, s, e) & np.uint64(1) if len(calls) == 1 else real(b, s, e)

    monkeypatch.setattr(co, "byte_ranges", weak)
    names, ids = co.word_ids(b"one two three four two")
    assert [names[i - 1] for i in ids if i] == ["one", "two", "three", "four", "two"]


def test_long_sequences_of_many_words_sort_alike():
    rnd = np.random.default_rng(0)
    ids = rnd.integers(0, 50, 3000)
    big = ids * 2**20  # too many symbols for one key
    assert (co.transform(big.copy(), 3) // 2**20).tolist().count(7) == co.transform(ids, 3).tolist().count(7)
    a, b = co.transform(big, 3) // 2**20, co.transform(ids, 3)
    key = np.sort(ids * 2500 + np.roll(ids, -1) * 50 + np.roll(ids, -2))
    for k in np.unique(key)[:200]:
        lo, hi = np.searchsorted(key, [k, k + 1])
        assert sorted(a[lo:hi]) == sorted(b[lo:hi])
