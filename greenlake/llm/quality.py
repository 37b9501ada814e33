"""Quality by ordinal cumulative-link regression on graded ratings over hashed-text features.

``P(grade > k) = 1 / (1 + exp(theta_k - w.x))``: one weight vector for all grades and ordered
thresholds. The expected grade is the sum of the tail probabilities; the last one decides selection.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenlake.llm.common import map_batches

BITS = 20
#: Lengths of the word beginnings that are features beside whole words, for inflected forms.
STEMS = (4, 5, 6)
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def _levels(name: str, value: float, top: int = 19) -> list[str]:
    """One feature for each level that a measure reaches, so that near values share most of them."""
    return [f"s {name} {k}" for k in range(1, min(int(value), top) + 1)]


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features of a text: its words and their beginnings, word endings of signs, and levels of its shape."""
    tokens = (text or "").split()
    if not tokens:
        return np.array([zlib.crc32(b"empty") & (1 << BITS) - 1], np.int32)
    bare = {t: t.strip(_EDGE) for t in set(tokens)}
    words = {b.lower() for b in bare.values()}
    n, d = len(tokens), len(bare)
    ends: dict[str, int] = {}
    for t in bare:
        if end := t[len(t.rstrip(_EDGE)) :]:
            ends[end] = ends.get(end, 0) + 1
    odd_ends = sum(c for e, c in ends.items() if len(e) > 1 or e not in ".,;:!?)'\"")
    lines = text.split("\n")
    said = ["w " + w for w in words] + ["e " + e for e in ends]
    said += _levels("odd", 20 * sum(not b.isalpha() for b in bare.values()) / d)
    said += _levels("upper", 20 * sum(len(b) > 1 and b.isupper() for b in bare.values()) / d)
    said += _levels("ends", 20 * odd_ends / d)
    said += _levels("same", 20 * sum(map(str.__eq__, tokens, tokens[1:])) / n)
    said += _levels("repeat", 20 * (1 - d / n))
    said += _levels("lines", 20 * (1 - len(set(lines)) / len(lines)))
    said += _levels("length", np.log2(n), 24) + _levels("word", sum(map(len, tokens)) / n, 24)
    for k in STEMS:
        said += {f"{k} {w[:k]}" for w in words if len(w) > k}
    return np.unique(np.array([zlib.crc32(s.encode("utf-8", "replace")) & (1 << BITS) - 1 for s in said], np.int32))


def _losses(score: np.ndarray, theta: np.ndarray, grades: np.ndarray):
    """Mean negative log-likelihood, and the log-likelihood's slope by each ``score - theta_k``."""
    tail = 1 / (1 + np.exp(np.clip(theta - score[:, None], -30, 30)))
    # The likelihood of grade g is tail_{g-1} - tail_g.
    above = np.concatenate([np.ones((len(tail), 1)), tail], 1)
    below = np.concatenate([tail, np.zeros((len(tail), 1))], 1)
    pick = np.arange(len(tail)), grades
    like = np.maximum(above[pick] - below[pick], 1e-9)
    slope = tail * (1 - tail) / like[:, None]
    for k in range(tail.shape[1]):
        slope[:, k] *= (grades == k + 1).astype(float) - (grades == k)
    return -np.log(like).mean(), slope / len(tail)


def _descend(at, row, grades, penalty, w, theta, steps, tolerance=1e-3):
    """Weights and thresholds by accelerated proximal steps on the L1-penalised likelihood."""
    n, p = len(grades), len(w)
    x, size = np.ones(p), 1.0
    for _ in range(12):  # the largest curvature, by power iteration
        x = np.bincount(at, np.bincount(row, x[at], n)[row], p)
        size = np.linalg.norm(x)
        x = x / max(size, 1e-12)
    bound = 0.25 * size / n + 0.25 * len(theta)
    z, z_theta, t = w, theta, 1.0
    for _ in range(steps):
        _, slope = _losses(np.bincount(row, z[at], n), z_theta, grades)
        new = z + np.bincount(at, slope.sum(1)[row], p) / bound
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / bound, 0)
        new_theta = np.maximum.accumulate(z_theta - slope.sum(0) / bound + np.arange(len(theta)) * 1e-9)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, z_theta = new + (last - 1) / t * (new - w), np.maximum.accumulate(new_theta + (last - 1) / t * (new_theta - theta))
        moved = np.abs(new - w).max(initial=0)
        w, theta = new, new_theta
        if moved < tolerance:
            break
    return w, theta


def _flat(examples):
    """(features, their numbers by entry, examples by entry), of those that more than one and not all examples have."""
    at = np.concatenate(examples)
    count = np.zeros(1 << BITS, np.int32)
    for e in examples:
        count[e] += 1  # an example's features are distinct
    some = np.nonzero((count > 1) & (count < len(examples)))[0]  # one alone can't be validated, what all have is the thresholds' part
    place = np.full(1 << BITS, -1, np.int32)
    place[some] = np.arange(len(some))
    at, row = place[at], np.repeat(np.arange(len(examples), dtype=np.int32), [len(e) for e in examples])
    return some, at[at >= 0], row[at >= 0]


def _start(grades, levels):
    share = np.array([np.clip((grades > k).mean(), 0.01, 0.99) for k in range(levels)])
    return np.maximum.accumulate(np.log((1 - share) / share) + np.arange(levels) * 1e-3)


def _summed(at, row, values, size, step=1 << 18):
    """The sum of ``values[row]`` for each feature, in steps that keep copies small."""
    out = np.zeros(size)
    for i in range(0, len(at), step):
        out += np.bincount(at[i : i + step], values[row[i : i + step]], size)
    return out


def _scores(at, row, w, n, step=1 << 18):
    """The sum of the weights of each example's features."""
    out = np.zeros(n)
    for i in range(0, len(at), step):
        out += np.bincount(row[i : i + step], w[at[i : i + step]], n)
    return out


def _evidence(at, row, size, grades, levels):
    """For each feature, the most standard deviations by which the examples that have it depart from the share above a grade."""
    total, most = _summed(at, row, np.ones(len(grades)), size), np.full(size, 1e-3)
    for k in range(levels):
        share = np.clip((grades > k).mean(), 1e-3, 1 - 1e-3)
        apart = _summed(at, row, (grades > k).astype(float), size) - total * share
        most = np.maximum(most, np.abs(apart) / np.sqrt(np.maximum(total, 1) * share * (1 - share)))
    return most


def _path(at, row, size, grades, levels, shares, steps, relaxed):
    """(features, weights, thresholds) at each penalty in turn, refitted on their support with a share of the penalty.

    A feature's penalty falls with its evidence (an adaptive lasso); ``shares`` are of the least that leaves none.
    """
    n, theta, w = len(grades), _start(grades, levels), np.zeros(size)
    hard = 1 / _evidence(at, row, size, grades, levels)
    most = None
    for share in shares:
        _, slope = _losses(_scores(at, row, w, n), theta, grades)
        pull = np.abs(_summed(at, row, slope.sum(1), size))
        most = most or (pull / hard).max(initial=0)
        penalty = share * most * hard
        active = ((pull >= 0.8 * penalty) | (w != 0))[at]
        used, own = np.unique(at[active], return_inverse=True)
        found, theta = _descend(own, row[active], grades, penalty[used], w[used], theta, steps)
        w = np.zeros(size)
        w[used] = found
        on = np.nonzero(w)[0]
        place = np.full(size, -1, np.int32)
        place[on] = np.arange(len(on))
        kept = (w != 0)[at]
        yield on, *_descend(place[at[kept]], row[kept], grades, relaxed * penalty[on], w[on], theta, steps)


def fit_ordinal(examples: list[np.ndarray], grades: np.ndarray, folds: int = 3, penalties: int = 16, steps: int = 150, relaxed: float = 0.3):
    """Weights and ordered thresholds by L1-penalised maximum likelihood.

    The penalty is chosen on a falling path by cross-validation over ``folds`` parts (equal examples in one
    part), so it follows from the sample at every size; a part's path ends where its validation loss has not
    fallen five times in a row, and penalties that all parts have reached are compared. Weights are refitted on their support with ``relaxed`` times the penalty.
    """
    levels = int(grades.max()) if len(grades) else 0
    if not levels or len(set(grades.tolist())) < 2:
        return np.zeros(1 << BITS), np.full(max(levels, 1), -4.0)
    some, at, row = _flat(examples)
    size, n = len(some), len(examples)
    path = 0.7 ** np.arange(1, penalties + 1)
    part = np.array([zlib.crc32(e.tobytes()) % folds for e in examples])
    losses = np.zeros(penalties)
    for f in range(folds):  # one after the other, as each copies its part of the sample
        inner, outer = part != f, part == f
        if not 0 < inner.sum() < n:
            continue
        order, entries, own = np.cumsum(inner, dtype=np.int32) - 1, inner[row], []
        for on, found, theta in _path(at[entries], order[row[entries]], size, grades[inner], levels, path, steps, relaxed):
            w = np.zeros(size)
            w[on] = found
            own.append(_losses(_scores(at, row, w, n)[outer], theta, grades[outer])[0] * outer.sum())
            if len(own) - int(np.argmin(own)) > 5:
                break
        losses = losses[: len(own)] + own[: len(losses)]
    best = int(np.argmin(losses)) + 1 if losses.any() else penalties
    *_, (on, found, theta) = _path(at, row, size, grades, levels, path[:best], steps, relaxed)
    w = np.zeros(1 << BITS)
    w[some[on]] = found
    return w, theta


def train(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_examples: int = 8000, max_chars: int = 1 << 26
):
    """Fit on at most ``max_examples`` rated documents, the first by a hash of their id that together have up to ``max_chars``
    (single texts over a sixteenth of that are no examples).

    ``ratings`` has the id and an integer grade from 0; null grades are left out and repeated ids take
    their lowest grade. Features of the sample, bounded by these two parameters, pass the driver.
    """
    rated = ratings.where(f"grade is not null and {id_col} is not null").groupBy(id_col).agg(F.min("grade").cast("int").alias("grade"))
    sample = rated.orderBy(F.xxhash64(id_col), id_col).limit(max_examples)
    long = F.coalesce(F.length(text_col), F.lit(0))
    sizes = docs.select(id_col, long.alias("_chars")).join(F.broadcast(sample), id_col).groupBy(id_col, "grade").agg(F.sum("_chars").alias("_chars"))
    order = Window.orderBy(F.xxhash64(id_col), id_col).rowsBetween(Window.unboundedPreceding, 0)  # over max_examples rows
    sizes = sizes.where(F.col("_chars") <= max_chars // 16).withColumn("_so_far", F.sum("_chars").over(order))
    chosen = sizes.where(F.col("_so_far") <= max_chars).select(id_col, "grade")
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)

    def make():
        return lambda grades, texts: (grades, [features(t).tobytes() for t in texts])

    got = map_batches(rows.select("grade", text_col), make, "grade int, at binary").collect()
    got.sort(key=lambda r: (r["grade"], r["at"]))
    return fit_ordinal([np.frombuffer(r["at"], np.int32) for r in got], np.array([r["grade"] for r in got], np.int64))


def grade(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", min_tail: float = 0.5) -> DataFrame:
    """All columns of ``docs`` with expected_grade, tail_probability (of the best grade) and kept.

    Columns of those names are replaced. A null or empty text is graded by its emptiness alone. Rows are
    independent; repeated rows each get their grade. A model without ratings keeps everything.
    """
    new = ["expected_grade", "tail_probability", "kept"]
    keep = [c for c in docs.columns if c.lower() not in new]
    rows = docs.select(*keep)
    at = keep.index(text_col)
    used = np.nonzero(model[0])[0]
    packed = (used.astype(np.int32), model[0][used].astype(np.float32), model[1])
    sent = docs.sparkSession.sparkContext.broadcast(packed)  # at most 2**BITS weights
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema)

    def make():
        places, values, theta = sent.value
        w = np.zeros(1 << BITS)
        w[places] = values

        def fn(*cols):
            tails = [1 / (1 + np.exp(np.clip(theta - w[features(t)].sum(), -30, 30))) for t in cols[at]]
            top = [float(t[-1]) for t in tails]
            return [*cols, [float(t.sum()) for t in tails], top, [t >= min_tail for t in top]]

        return fn

    return map_batches(rows, make, schema + "expected_grade double, tail_probability double, kept boolean")
