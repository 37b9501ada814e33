import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from greenlake.llm import common
from greenlake.llm import jaccard_join as j


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = {k: sets_of(t) for k, t in docs}
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: (len(sets[k]), root(k)) for k in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    common_words = rng.choices(vocab, k=25)  # a passage that most documents share
    docs, k = [], 0
    for g in range(14):
        base = rng.choices(vocab, k=rng.choice([3, 6, 8, 9, 12, 20, 40, 90, 300]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            if g % 2:
                own += common_words
            if rng.random() < 0.3:
                own = own[: len(own) - rng.randint(0, len(own) // 8)]
            docs.append((k, " ".join(own).upper() if rng.random() < 0.2 else "\t".join(own)))
            k += 1
    return docs + [(k, None), (k + 1, ""), (k + 2, " \n"), (k + 3, "one two"), (k + 4, "One  two"), (k + 5, "x " * 30000)]


def test_against_brute_force(frame, monkeypatch):
    for seed in (1, 2):
        if seed == 2:  # every bucket is compared in blocks
            monkeypatch.setattr(j, "SMALL", 1)
            monkeypatch.setattr(j, "BLOCK", 3)
        docs = corpus(seed)
        want = brute(docs)
        assert sum(c != k for k, (_, c) in want.items()) > 10
        got = j.similar_documents(frame([(k, t, 0) for k, t in docs], "doc_id long, text string, n int"), rounds=1 + seed, bits=16)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


@settings(max_examples=300, deadline=None)
@given(st.integers(4, 400), st.integers(0, 10**9), st.floats(0, 1))
def test_linked_sets_share_enough_segments(n, seed, part):
    """The pigeonhole: sets of Jaccard 0.8 or more share at least `slack` segments of a band."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
    most = len(a) // 5
    drop, add = int(part * most), int(rng.integers(0, most + 1))
    b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64) * np.uint64(2) + np.uint64(1)]))
    both = len(np.intersect1d(a, b))
    if both * 100 < 80 * len(np.union1d(a, b)) or drop + add == 0:
        return
    x, y = ({band: set(s.tolist()) for band, _, s, _ in j.segments(v)} for v in (a, b))
    assert any(len(x[band] & y[band]) >= j.slack_of(band) for band in x.keys() & y.keys())
    p, q = ({band: np.frombuffer(k, np.uint8) for band, _, _, k in j.segments(v)} for v in (a, b))
    assert all((p[band] != q[band]).sum() <= drop + add for band in p.keys() & q.keys())


def test_components(frame):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (200, 199), (200, 198)]
    got = {r["id"]: r["component"] for r in common.connected_components(frame(path, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 198, 199: 198, 198: 198}
    assert common.connected_components(frame([], "u long, v long")).count() == 0


def test_repeated_ids_and_empty(frame):
    text = " ".join(f"w{i}" for i in range(50))
    docs = frame([(5, text), (5, text), (2, text + " x"), (None, text), (None, None)], "doc_id long, text string")
    rows = j.similar_documents(docs).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [(-1, -1), (-1, 2), (2, 2), (5, 2), (5, 2)]
    assert j.similar_documents(docs.where("false")).count() == 0


def test_a_full_bitmap_still_thins_out(frame, monkeypatch):
    """More shared segments than the bitmap has room for: documents that are like no other hand on few segments, and no set of theirs is stored."""
    rng, stored = random.Random(3), {}
    real = j.written

    def kept(df, name, **options):
        stored.setdefault(name, []).append(real(df, name, **options))
        return stored[name][-1]

    monkeypatch.setattr(j, "written", kept)
    docs = []
    for k in range(120):
        words = [f"w{rng.randrange(10**6)}" for _ in range(500)]
        docs.append((k, " ".join(words)))
        if k < 25:
            docs.append((1000 + k, " ".join([*words[:490], "x"])))
    got = {r["doc_id"]: r["component_id"] for r in j.similar_documents(frame(docs, "doc_id long, text string"), bits=16).collect()}
    assert got == {k: k % 1000 for k, _ in docs}
    assert 16 * stored["segments"][0].count() > 1 << 16
    alone = [f.where("size(bands) > 0 and id between 25 and 119").count() for fs in stored.values() for f in fs if {"id", "bands"} <= set(f.columns)]
    assert len(alone) == 1 and alone[0] < 50
    assert [f.columns for fs in stored.values() for f in fs if {"id", "shingles"} <= set(f.columns)] == []
    (sets,) = stored["sets"]
    assert 50 <= sets.count() < 60


def test_component_ids_are_not_broadcast(frame):
    """The ids that rows are joined to are never made more than the rows are, nor sent to the driver."""
    rows = frame([(i, i // 2 if i % 7 else None) for i in range(3000)] + [(None, 4)], "id long, root long")
    out = common.with_component_id(rows)
    got = {r["id"]: r["component_id"] for r in out.collect()}
    least = {}
    for i in range(3000):
        if i % 7:
            least.setdefault(i // 2, i)
    assert got == {None: least[4]} | {i: least[i // 2] if i % 7 else i for i in range(3000)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "Generate" not in plan
