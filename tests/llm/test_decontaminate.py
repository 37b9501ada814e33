import random
import re
from itertools import combinations

from greenlake.llm import decontaminate as d

VOCAB = [f"word{i}" for i in range(3000)]


def brute(docs, items, overlap=20, similarity=0.8):
    """All alignments on which some `overlap` consecutive words of the item agree enough."""
    import math

    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    found = set()
    for k, t in docs:
        w = split(t)
        for i, x in items:
            v = split(x)
            if not v:
                continue
            for shift in range(-len(v), len(w)):
                same = [0 <= shift + j < len(w) and w[shift + j] == v[j] for j in range(len(v))]
                wide = min(overlap, len(v))
                if max(sum(same[s : s + wide]) for s in range(len(v) - wide + 1)) >= (wide if len(v) < 7 else math.ceil(wide * similarity)):
                    found.add((k, i))
    return found


def test_against_brute_force(frame):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choices(VOCAB, k=n))) for i, n in enumerate([3, 7, 10, 14, 15, 16, 25, 40, 60])] + [(50, None), (51, "")]
    docs = []
    for k in range(60):
        body = rng.choices(VOCAB, k=rng.randint(0, 120))
        if k % 2:
            i, text = items[rng.randrange(9)]
            piece = text.split()
            if k % 3 == 0 and len(piece) > 8:
                piece[rng.randrange(len(piece))] = "changed"  # one substitution is always tolerated
            at = rng.randint(0, len(body))
            body[at:at] = piece
        docs.append((k, (" " if k % 4 else ", ").join(body).upper() if k % 5 == 0 else " ".join(body)))
    schema = "doc_id long, text string"
    want = brute(docs, items)
    assert len(want) > 15
    got = d.contaminated(frame([(k, t, "n") for k, t in docs], "doc_id long, text string, item string"), frame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    joined = d.contaminated(frame(docs, schema), frame(items, "item_id long, text string"), broadcast_seeds=0, broadcast_hits=0).collect()
    assert {(r["doc_id"], r["item_id"]) for r in joined} == want


def test_rows_kept_and_edges(frame):
    item = " ".join(VOCAB[:20])
    docs = frame([(1, f"a {item} b"), (1, f"a {item} b"), (2, None), (3, ""), (None, item), (4, "clean text"), (5, item + " " + "x " * 20000)], "doc_id long, text string")
    bench = frame([(7, item)], "item_id long, text string")
    assert {r["doc_id"] for r in d.contaminated(docs, bench).collect()} == {1, None, 5}
    left = d.decontaminate(docs, bench)
    assert left.columns == ["doc_id", "text"] and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
    assert d.decontaminate(docs, bench.where("false")).count() == 7
    assert d.contaminated(docs.where("false"), bench).count() == 0


def test_no_python_in_the_plan(frame):
    plan = d.contaminated(frame([(1, "a")], "doc_id long, text string"), frame([(1, " ".join(VOCAB[:20]))], "item_id long, text string"))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())


def test_substitutions_at_every_offset(frame):
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices(VOCAB, k=n))) for i, n in enumerate([7, 10, 11, 15, 20, 30, 40])]
    docs = []
    for i, text in items:
        n = len(text.split())
        changes = [rng.sample(range(n), k) for k in (1, 2, 3, 4) for _ in range(3)] + [range(4, n, 5)]  # every fifth word too
        if n == 20:
            changes.append((6, 11))
        for places in changes:
            piece = text.split()
            for j in places:
                piece[j] = "changed"
            docs += [(len(docs) + k, " ".join(["before"] * k + piece + ["after"])) for k in range(4)]
    want = brute(docs, items)
    assert len(want) > 150
    got = d.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)


def test_every_accepted_pattern_has_a_hit():
    """So recall is 1 at every accepted rate and width."""
    served = d.families(20, 0.8)
    assert sorted(w for x in served.values() for w in x) == list(range(1, 21))
    for masks, widths in served.items():
        for wide in widths:
            need = wide if wide < 7 else -(-wide * 4 // 5)
            assert any("0" in m for m in masks) or need == wide
            for off in combinations(range(wide), wide - need):
                same = "".join("0" if i in off else "1" for i in range(wide))
                assert any(all(same[at + i] == "1" for i, c in enumerate(m) if c == "1") for m in masks for at in range(wide - len(m) + 1))


def test_clashing_names(frame):
    docs = frame([(1, " ".join(VOCAB[:20]), "x", "y"), (2, "clean", "x", "y")], "doc_id long, text string, _b string, _h string")
    left = d.decontaminate(docs, frame([(7, " ".join(VOCAB[:20]))], "item_id long, text string"))
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, "clean", "x", "y")]


def test_openings_that_many_items_share(frame):
    """Common words of several lengths, some items that differ in a word only, places at both ends of texts and blocks."""
    rng = random.Random(12)
    said = lambda n: rng.choices(VOCAB, k=n)
    opening, longer, frequent = said(8), said(15), said(3)
    items = [(i, " ".join(opening + said(rng.randint(4, 20)))) for i in range(40)]
    items += [(100 + i, " ".join(longer[:12] + rng.choices(frequent, k=4) + said(rng.randint(0, 4)))) for i in range(40)]
    items += [(200 + i, " ".join(longer + [w])) for i, w in enumerate(said(20))] + [(300, " ".join(["again"] * 30)), (300, " ".join(["again"] * 30))]
    docs = []
    for k in range(50):
        body = opening * rng.randint(0, 4) + said(rng.randint(0, 6)) + opening + said(3)
        for _ in range(2):
            piece = rng.choice(items)[1].split()
            for j in rng.sample(range(len(piece)), rng.randint(0, min(5, len(piece) // 4))):
                piece[j] = "changed"
            body += piece
        docs.append((k, " ".join(body)))
    docs += [(60, "again " * 40), (61, " ".join(said(4090) + items[0][1].split() + said(10))), (None, items[1][1]), (62, None)]
    want = brute(docs, items)
    assert 100 < len(want) < 4000
    made = frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")
    rows = lambda **o: sorted(map(tuple, d.contaminated(*made, **o).collect()), key=str)
    got = rows(common_seed=5)
    assert {(r[0], r[2]) for r in got} == want and len(got) == len(want)
    assert got == rows() == rows(common_seed=0, broadcast_seeds=0, broadcast_hits=0)


def test_a_common_opening_makes_few_alignments(frame, monkeypatch):
    rng = random.Random(4)
    opening = rng.sample(VOCAB, 8)
    items = [(i, " ".join(opening + rng.choices(VOCAB, k=12))) for i in range(1000)]
    docs = [(k, " ".join(w for _ in range(20) for w in opening + rng.choices(VOCAB, k=10))) for k in range(200)] + [(500, items[7][1])]
    made, write = [], d.written

    def counted(df, name, *more):
        out = write(df, name, *more)
        if name == "alignments":
            made.append(out.count())
        return out

    monkeypatch.setattr(d, "written", counted)
    got = d.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(500, 7)]
    assert made and made[0] < 100_000  # of 4,000,000
