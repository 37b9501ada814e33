import math

import numpy as np

from greenlake.llm import embedding_dedup as e


def brute(rows, least=0.98):
    ok = [r for r in rows if r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    links, up = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ok):
        for b in ok[i + 1 :]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= least:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    p, q = sorted((root(a[0]), root(b[0])))
                    up[q] = p
    return {r[0]: (links[r[0]], root(r[0]), root(r[0]) == r[0]) for r in rows}


def vectors():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in range(3):
        for _ in range(25):
            base = rng.standard_normal(16)
            for _ in range(rng.integers(1, 5)):
                v = base * rng.uniform(0.5, 3) + rng.standard_normal(16) * rng.choice([0, 0.01, 0.1, 0.2])
                rows.append((k, [float(x) for x in v.astype(np.float32)], label))
                k += 1
    same = rows[0][1]
    odd = [(same, 0), (same, 0), (same, 1), (same, None), ([0.0] * 16, 0), (None, 0), ([], 0), ([None] + same[1:], 0), ([math.nan] + same[1:], 0), ([math.inf] + same[1:], 0), (same[:8], 0), ([1e30 * x for x in same], 0)]
    return rows + [(k + i, v, g) for i, (v, g) in enumerate(odd)]


def test_against_brute_force(frame, monkeypatch):
    rows = vectors()
    want = brute(rows)
    assert sum(v[0] for v in want.values()) > 60
    for block in (1024, 3):  # buckets in one block, or cut
        monkeypatch.setattr(e, "BLOCK", block)
        got = e.near_duplicates(frame([(*r, "n") for r in rows], "vec_id long, embedding array<float>, label int, n_links string")).collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == want and len(got) == len(rows)


def test_miss_rate_holds():
    for rows in (100, 10**5, 10**8):
        k, tables = e.plan(rows, 0.98, 1e-6)
        assert (1 - e.collision(0.2) ** k) ** tables <= 1e-6
    rng = np.random.default_rng(0)
    u = rng.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.standard_normal((4000, 64))
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.98 * u + math.sqrt(1 - 0.98**2) * w
    k, tables = e.plan(4000, 0.98, 1e-6)
    assert np.all((e.keys_of(u, k, tables, 7) == e.keys_of(v, k, tables, 7)).any(1))


def test_repeated_ids_and_empty(frame):
    schema = "vec_id long, embedding array<float>, label int"
    rows = e.near_duplicates(frame([(3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)], schema)).collect()
    assert [r["n_links"] for r in rows] == [3] * 4 and {r["component_id"] for r in rows} == {1}
    assert e.near_duplicates(frame([], schema)).count() == 0


def test_groups_stay_bounded(frame, monkeypatch):
    monkeypatch.setattr(e, "BLOCK", 16)
    monkeypatch.setattr(e, "GROUP_ROWS", 256)
    groups = []

    def counted(x, buckets, seed=7):
        out = pairs(x, buckets, seed)
        groups.extend(r["count"] for r in out.groupBy("part").count().collect())
        return out

    pairs = e.block_pairs
    monkeypatch.setattr(e, "block_pairs", counted)
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, [float(v) for v in base + rng.standard_normal(16) * 1e-3], 0) for i in range(400)]
    got = e.near_duplicates(frame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(399, 0)}
    assert sum(groups) > 100_000 // 8 and max(groups) < 4 * 256
