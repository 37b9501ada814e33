import hashlib
import random
import re

import numpy as np

from greenlake.llm import queries
from greenlake.llm import substring_dedup as s
from greenlake.llm.hashing import byte_ranges


def brute(docs, min_sentences=3, min_words=24):
    """Sentence numbers that a non-first repeated span covers."""
    seen, gone = {}, {}
    for k, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        parts = s.sentences(t)
        for i in range(len(parts)):
            n = words = 0
            while i + n < len(parts) and (n < min_sentences or words < min_words):
                words += parts[i + n][3]
                n += 1
            if n < min_sentences or words < min_words:
                continue
            key = tuple(p[2] for p in parts[i : i + n])
            if key in seen:
                gone.setdefault(k, set()).update(range(i, i + n))
            seen.setdefault(key, (k, i))
    return {k: sorted(v) for k, v in gone.items()}


def test_sentences_cover_the_words():
    text = "One two.  Three!\nfour" + " five" * 40 + ". ??? \n\n six"
    parts = s.sentences(text)
    assert " ".join(p[2] for p in parts).split() == text.lower().split()
    assert all(p[3] <= 16 for p in parts) and all(a[1] <= b[0] for a, b in zip(parts, parts[1:]))
    assert s.sentences(None) == s.sentences("") == s.sentences(" \n ") == []


def test_against_brute_force(frame):
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 30))) + "."
    passages = [" ".join(sentence() for _ in range(6)) for _ in range(4)] + ["w " * 60]
    docs = [(k, " ".join([sentence() for _ in range(rng.randint(0, 4))] + rng.sample(passages, rng.randint(0, 2)) + [sentence()])) for k in range(40)]
    docs += [(100, None), (101, ""), (102, passages[0] + " " + passages[0]), (103, "x y z. " * 2000)]
    want = brute(docs)
    got = {r["doc_id"]: r["removed"] for r in s.repeated_sentences(frame(docs, "doc_id long, text string")).collect()}
    assert got == want and len(want) > 10
    bare = s.repeated_sentences(frame(docs, "doc_id long, text string"), bits=0)  # without a bitmap
    assert {r["doc_id"]: r["removed"] for r in bare.collect()} == want


def test_texts(frame):
    passage = "The first sentence has eight words in it. The second one also has some more words. And then a third follows with yet more words."
    docs = frame([(1, f"Own start. {passage} Own end.", 9), (2, f"Other. {passage} Last.", 9), (3, None, 9), (None, passage, 9)], "doc_id long, text string, n_removed int")
    rows = {r["doc_id"]: r for r in s.remove_repeats(docs).collect()}
    assert rows[1]["n_removed"] == 0 and rows[1]["text"].startswith("Own start. The first")
    assert rows[2]["text"].split() == ["Other.", "Last."] and rows[2]["n_removed"] == 3
    assert rows[3]["text"] is None and rows[None]["text"].strip() == ""
    assert {r["doc_id"] for r in s.remove_repeats(docs, only_changed=True).collect()} == {2, None}
    assert s.remove_repeats(docs.where("false")).count() == 0


def test_rows_that_share_an_id(frame):
    passage = "The first sentence has eight words in it. The second one also has some more words. And then a third follows with yet more words."
    own = " ".join(f"Sentence {i} of this row says a few things of its own." for i in range(8))
    docs = frame([(1, passage), (None, passage), (None, own), (5, "Other text. " + passage), (5, own.upper() + " X")], "doc_id long, text string")
    rows = sorted((r["text"].strip(), r["n_removed"]) for r in s.remove_repeats(docs).collect() if r["doc_id"] != 1)
    # ``own`` is first in document 5, so the row without an id loses its copy; nothing else is touched.
    assert rows == sorted([("", 3), ("", 8), ("Other text.", 3), (own.upper() + " X", 0)])
    alone = s.remove_repeats(docs.where("doc_id is null or doc_id = 1"))
    assert {r["text"].strip() for r in alone.collect()} == {passage, "", own}


def test_repeats_inside_long_sentences(frame):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(50)]
    docs = [(0, " ".join([word() for _ in range(20)] + passage + [word() for _ in range(20)]) + ".")]
    docs += [(k, " ".join([word() for _ in range(20 + k)] + passage + [word() for _ in range(30 - k)]) + ".") for k in range(1, 17)]
    for r in s.remove_repeats(frame(docs, "doc_id long, text string")).collect():
        left = sum(w in r["text"].split() for w in passage)
        # Windows of 9 words leave at most 8 words on either side of the cuts that all copies share.
        assert left == 50 if r["doc_id"] == 0 else left <= 16


def test_runs_end_where_the_repeat_ends(frame):
    said = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n)) + "."
    run = " ".join([said("a", 16), said("b", 5), said("c", 4), said("d", 3)])
    rows = frame([(1, f"{run} {said('x', 9)}"), (2, f"{run} {said('y', 9)}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in s.remove_repeats(rows).collect()} == {1: 0, 2: 4}


def test_clashing_names(frame):
    passage = "The first sentence has eight words in it. The second one also has some more words. And then a third follows with yet more words."
    docs = frame([(1, passage, "a", "b", "c"), (2, passage, "d", "e", "f")], "doc_id long, text string, removed string, _id string, _hash string")
    rows = {r["doc_id"]: r for r in s.remove_repeats(docs).collect()}
    assert rows[1]["removed"] == "a" and rows[2]["_id"] == "e" and rows[2]["n_removed"] == 3


def plain_parts(text, piece_words=16, window=9):
    """Word lists of a text's parts, by patterns and loops; only the hash of a word is the operator's."""
    out = []
    for sentence in re.split(r"(?<=[.!?])(?![.!?])|(?<=\n)", (text or "").lower()):
        words = re.findall(r"[^ \t-\r]+", sentence)
        cuts = {0, len(words)}
        if len(words) > piece_words:
            said = [np.frombuffer(w.encode(), np.uint8) for w in words]
            h = [int(byte_ranges(b, np.array([0]), np.array([len(b)]))[0]) for b in said]
            for i in range(len(words) - window + 1):
                low = min(h[i : i + window])
                cuts.add(max(j for j in range(i, i + window) if h[j] == low) + 1)
        ends = sorted(cuts)
        out += [words[a:b] for a, b in zip(ends, ends[1:]) if a < b]
    return out


def every_run(docs, min_sentences=3, min_words=24):
    """Parts that a run of any length, long enough and seen before, covers."""
    seen, gone = set(), {}
    for k, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        parts = [tuple(p) for p in plain_parts(t)]
        for i in range(len(parts)):
            for n in range(min_sentences, len(parts) - i + 1):
                if sum(map(len, parts[i : i + n])) < min_words:
                    continue
                run = tuple(parts[i : i + n])
                if run in seen:
                    gone.setdefault(k, set()).update(range(i, i + n))
                seen.add(run)
    return {k: sorted(v) for k, v in gone.items()}


def test_the_query_removes_what_runs_of_every_length_cover(frame, spark, tmp_path):
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 4)))
    sentence = lambda: " ".join(word() for _ in range(rng.choice([1, 3, 5, 9, 16, 17, 40]))) + rng.choice([".", "?!", "...", "\n", ".\r\n"])
    passages = [[sentence() for _ in range(rng.randint(3, 12))] for _ in range(8)]
    docs = []
    for k in range(69):
        body = []
        for passage in rng.sample(passages, rng.randint(0, 3)):
            i = rng.randrange(len(passage))
            body += [sentence() for _ in range(rng.randint(0, 2))] + passage[i : rng.randint(i, len(passage))]  # any part of a passage
        docs.append((k, rng.choice([" ", "  ", "\t"]).join(body)))
    docs += [(70, None), (71, ""), (72, " \n "), (73, "x y z. " * 30), (74, "Q" * 5000), (None, docs[9][1]), (75, docs[9][1]), (76, docs[9][1].upper())]
    want = every_run(docs)
    assert len(want) > 20 and any(len(v) > 6 for v in want.values())
    rows = frame(docs, "doc_id long, text string")
    kept = {r["doc_id"]: r for r in s.remove_repeats(rows).collect()}
    assert len(kept) == len(docs)
    for k, text in docs:
        parts, gone = plain_parts(text), want.get(k, [])
        assert (kept[k]["n_sentences"], kept[k]["n_removed"]) == (len(parts), len(gone)), k
        left = [w for i, p in enumerate(parts) if i not in gone for w in p]
        assert re.findall(r"[^ \t-\r]+", (kept[k]["text"] or "").lower()) == left or not gone
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op6_substring_dedup(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        text = kept[k]["text"]
        assert (r["n_sentences"], r["n_removed"], r["kept_chars"]) == (kept[k]["n_sentences"], len(want[k]), len(text))
        assert r["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()
