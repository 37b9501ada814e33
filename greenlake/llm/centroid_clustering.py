"""Centroid clustering in integers, the nearest centroid found by a bisector tournament.

For centroids a and b the vectors nearer to b lie on one side of a plane: ``x . 2(b - a) > |b|^2 - |a|^2``. Normals and
thresholds of all pairs are computed once a round; a vector then meets the centroids in order, each test of a sign
eliminates one, and zero keeps the smaller number. All of it is exact integer arithmetic.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.llm.common import map_batches, written

#: Up to this size of a component, products and distances of 64 components fit in 64 bits; beyond it Python's integers take over.
NARROW = 1 << 26
#: Most numbers in the table of normals, which each task holds.
MAX_NORMALS = 1 << 26


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, scale: int = 256) -> DataFrame:
    """Rows (id, x) of the vectors with exactly ``size`` components, none null or non-finite, as ``floor(scale * component)``.

    A component must fit in a long once scaled; a larger one is an error, as no distance of it could be returned.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    is_finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where((F.size("v") == size) & F.forall("v", is_finite))

    def make():
        def fn(ids, vectors):
            x = np.floor(np.array(vectors, np.float64).reshape(len(ids), size) * float(scale))
            if len(x) and np.abs(x).max() >= 2.0**63:
                raise ValueError("a scaled component does not fit in a long")
            return [ids, list(x.astype(np.int64))]

        return fn

    return map_batches(kept, make, f"id {kind}, x array<bigint>")


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that order; equal ids go by their components, null ids last."""
    named = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), "x")
    return [r["x"] for r in named.orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()]


class Tournament:
    """Normals and thresholds of all pairs of ``centroids``, and the tests over them."""

    def __init__(self, centroids: list[list[int]]):
        if len(centroids) ** 2 * len(centroids[0]) > MAX_NORMALS:
            raise ValueError(f"the normals of {len(centroids)} centroids exceed {MAX_NORMALS} numbers")
        c = np.array(centroids, object)
        self.wide = bool(np.abs(c).max() > NARROW)
        self.centroids = c if self.wide else c.astype(np.int64)
        self._tables(self.centroids)

    def _tables(self, c):
        squares = (c * c).sum(1)
        self.normals = 2 * (c[None, :] - c[:, None])  # at [a, b]: towards b
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each row's nearest centroid and the exact squared distance to it."""
        if not self.wide and len(x) and np.abs(x.astype(np.float64)).max() > NARROW:
            self.wide, self.centroids = True, self.centroids.astype(object)
            self._tables(self.centroids)
        if self.wide:
            x = x.astype(object)
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            # Every centroid met so far has a smaller number than j, so only a positive sign puts j first.
            side = (x * self.normals[best, j]).sum(1) - self.thresholds[best, j]
            best = np.where(side > 0, j, best)
        apart = x - self.centroids[best]
        return best, (apart * apart).sum(1)


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, list[int]]:
    """For each centroid that has vectors: their number, their summed distance, their summed components.

    Each task hands on one row for a centroid at most.
    """
    k, size = len(centroids), len(centroids[0])

    def make():
        game, count, total, inertia = Tournament(centroids), np.zeros(k, object), np.zeros((k, size), object), np.zeros(k, object)

        def fn(rows):
            if rows:
                x = np.array(rows, np.int64)
                best, far = game.nearest(x)
                for j in np.unique(best):
                    mine = best == j
                    narrow = int(np.abs(x[mine].astype(np.float64)).max()) < (1 << 62) // len(rows)
                    count[j] += int(mine.sum())
                    total[j] += (x[mine].sum(0) if narrow else x[mine].astype(object).sum(0)).astype(object)
                    inertia[j] += sum(far[mine].tolist())
            return [[]] * 2

        def rest():
            some = [j for j in range(k) if count[j]]
            return [some, [[str(v) for v in (count[j], inertia[j], *total[j])] for j in some]]

        return fn, rest

    parts = map_batches(vectors.select("x"), make, "cluster int, sums array<string>").select("cluster", F.posexplode("sums").alias("i", "v"))
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).orderBy("cluster", "i").collect():
        out.setdefault(r["cluster"], []).append(int(r["v"]))
    return out


def cluster(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = 64, k: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2
) -> tuple[DataFrame, list[list[int]]]:
    """Cluster vectors around ``k`` centroids; returns the rows and the final centroids.

    Rows (id, cluster, distance, cluster_inertia, inertia), one for each kept vector; vectors of another length or with a
    null or non-finite component are left out. Fewer than ``k`` vectors make as many centroids. Repeated rows stay
    rows of their own, null ids too; other columns are not read; an empty table gives an empty one.

    A round sends k centroids to the tasks and gets k sums from each: what passes through the driver is bounded by k.
    """
    spark, kind = rows.sparkSession, rows.schema[id_col].dataType.simpleString()
    vectors = written(quantised(rows, id_col, vector_col, size, scale), "vectors")
    centroids = first_centroids(vectors, k, seed)
    schema = f"`{id_col}` {kind}, cluster int, distance bigint"
    if not centroids:
        return spark.createDataFrame([], schema + ", cluster_inertia bigint, inertia bigint"), []
    for _ in range(rounds):
        for j, (n, _, *total) in _sums(vectors, centroids).items():
            centroids[j] = [v // n for v in total]  # the exact floor
    inertia = {j: s[1] for j, s in _sums(vectors, centroids).items()}
    final = [list(map(int, c)) for c in centroids]

    def make():
        game = Tournament(final)

        def fn(ids, xs):
            if not ids:
                return [[]] * 3
            best, far = game.nearest(np.array(xs, np.int64))
            return [ids, best.tolist(), far.tolist()]

        return fn

    found = map_batches(vectors.select("id", "x"), make, schema)
    sums = spark.createDataFrame([(j, s, sum(inertia.values())) for j, s in inertia.items()], "cluster int, cluster_inertia bigint, inertia bigint")
    return found.join(F.broadcast(sums), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia"), final
