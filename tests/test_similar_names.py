import random

import pytest

from greenlake.operators import growth, linkage


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def mutated(rnd, text):
    t = list(text)
    for _ in range(rnd.randrange(0, 5)):
        at = rnd.randrange(0, len(t) + 1)
        t[at : at + rnd.randrange(0, 2)] = rnd.choice(["", "a", "b", "é", "xy"])
    return "".join(t)


@pytest.mark.parametrize("least", [0.5, 0.6, 0.75, 0.9, 1.0])
def test_against_all_pairs(spark, least):
    rnd = random.Random(int(least * 100))
    words = ["".join(rnd.choice("aab") for _ in range(rnd.randrange(1, 12))) for _ in range(30)]
    words += ["a" * n for n in range(1, 30)]  # one hot letter
    words += ["quercus robur", "quercus rubra", "acer rubrum", "é", "日本"]
    left, right = words + ["", "zzz"], [mutated(rnd, w) for w in words * 2]
    got = linkage.similar_names(spark.createDataFrame([(w,) for w in left], "a string"), spark.createDataFrame([(w,) for w in right] + [(None,)], "b string"), least)
    like = lambda a, b: 1 - distance(a, b) / max(len(a), len(b))
    want = {(a, b): like(a, b) for a in set(left) - {""} for b in set(right) - {""} if like(a, b) >= least}
    assert {(r["left"], r["right"]): pytest.approx(r["similarity"]) for r in got.collect()} == want
    assert len(got.collect()) == len(want)


def test_bounds_and_suggestions(spark):
    one = spark.createDataFrame([("a",)], "a string")
    with pytest.raises(ValueError):
        linkage.similar_names(one, one, 0.3)
    names = spark.createDataFrame([("Red Gum",), ("red gum",), ("Bed Gum",), ("Ash",)], "name string")
    asked = spark.createDataFrame([(1, " RED GUM "), (2, "nothing"), (3, None)], "request_id long, request string")
    rows = growth.name_suggestions(asked, names).orderBy("rank").collect()
    assert [(r["request_id"], r["name"], r["rank"]) for r in rows] == [(1, "red gum", 1), (1, "bed gum", 2)]


def test_grams_are_made_for_distinct_texts(spark):
    """Rows that repeat a text are made one before its q-grams are: no filter on them goes below."""
    names = spark.createDataFrame([("red gum",), ("red gun",)], "name string").repartition(2)
    plan = linkage.similar_names(names, names, 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "sequence(1" in line]
