import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from greenlake.llm import centroid_clustering as cc

SCHEMA = "vec_id long, embedding array<double>, cluster string"


def brute(rows, size, k, rounds, scale=256, seed=2):
    """Lloyd's rounds with Python's integers and whole distances; rows as (id, vector) that are kept, in any order."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [x for _, x in sorted(kept, key=key)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for j, g in groups.items():
            centroids[j] = [sum(c) // len(g) for c in zip(*g)]
    found = [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept]
    inertia = {j: sum(d for _, c, d in found if c == j) for _, j, _ in found}
    return sorted(((i, j, d, inertia[j], sum(inertia.values())) for i, j, d in found), key=str), centroids


def test_against_whole_distances(frame):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) + rnd.choice([0, 1e-3]) for _ in range(4)], "x") for i in range(300)]
    rows += [(7, [0.5, 0.5, 0.5, 0.5], "x")] * 3 + [(None, [1.0, 0.0, 0.0, 0.0], None), (None, None, "x"), (900, [1.0, 2.0, 3.0], "x"), (901, [1.0, None, 0.0, 0.0], "x")]
    rows += [(902, [float("nan"), 0.0, 0.0, 0.0], "x"), (903, [float("inf"), 0.0, 0.0, 0.0], "x"), (904, [], "x")]
    want, centroids = brute([r[:2] for r in rows], 4, 9, 4)
    got, final = cc.cluster(frame(rows, SCHEMA).repartition(5), size=4, k=9, rounds=4)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert final == centroids


@pytest.mark.parametrize("scale", [1 << 28, 1 << 40])
def test_large_components_stay_exact(frame, scale):
    rows = [(i, [i * 0.5, 1.0 - i, 3.25 + i], "x") for i in range(8)]
    if scale == 1 << 40:  # far from zero and near each other, so that distances still are longs
        rows = [(i, [1000.0 + i * 2**-40, -5.0, 0.0], "x") for i in range(8)]
    want, centroids = brute([r[:2] for r in rows], 3, 3, 3, scale)
    got, final = cc.cluster(frame(rows, SCHEMA), size=3, k=3, rounds=3, scale=scale)
    assert sorted(map(tuple, got.collect()), key=str) == want and final == centroids


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_tournament_breaks_ties_by_number(data):
    number = st.integers(-3, 3)
    centroids = data.draw(st.lists(st.lists(number, min_size=2, max_size=2), min_size=1, max_size=7))
    x = np.array(data.draw(st.lists(st.lists(number, min_size=2, max_size=2), min_size=1, max_size=9)), np.int64)
    best, far = cc.Tournament(centroids).nearest(x)
    for row, j, d in zip(x.tolist(), best.tolist(), far.tolist()):
        assert (d, j) == min((sum((a - b) ** 2 for a, b in zip(row, c)), n) for n, c in enumerate(centroids))


def test_few_or_no_vectors(frame):
    got, centroids = cc.cluster(frame([(1, [1.0, 2.0], "x"), (1, [1.0, 2.0], "x")], SCHEMA), size=2, k=5, rounds=2)
    assert sorted(map(tuple, got.collect())) == [(1, 0, 0, 0, 0)] * 2 and centroids == [[256, 512]] * 2
    got, centroids = cc.cluster(frame([], SCHEMA), size=2)
    assert got.count() == 0 and centroids == []


def test_a_table_of_normals_has_a_bound():
    with pytest.raises(ValueError, match="normals"):
        cc.Tournament([[0] * 2000] * 2000)
