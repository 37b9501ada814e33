"""Embedding near-dedup with Euclidean p-stable hashing.

Unit vectors are projected on Gaussian directions, shifted and cut into cells; a table's key joins the
cells of several projections. Vectors that share a key in some table are compared by exact cosine. The
number of projections follows from the largest label's size and the number of tables from the miss rate
allowed at the threshold, so recall does not fall as the input grows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenlake.llm.common import connected_components, map_batches, with_component_id, written

WIDTH = 2.0
BLOCK = 1024
GROUP_ROWS = 16384


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at a distance fall in the same cell of one projection."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(rows: int, min_cosine: float, miss: float) -> tuple[int, int]:
    """Projections in a key and number of tables for a label of so many rows."""
    near, far = collision(math.sqrt(2 - 2 * min_cosine)), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(rows, 1) / BLOCK + 1) / -math.log(far)) + 4)
    return k, math.ceil(math.log(miss) / math.log(1 - near**k))


def keys_of(unit: np.ndarray, k: int, tables: int, seed: int) -> np.ndarray:
    """32-bit keys of unit vectors, one column for each table."""
    rng = np.random.default_rng([seed, unit.shape[1]])
    directions = rng.standard_normal((unit.shape[1], k * tables))
    cells = np.floor((unit @ directions + rng.uniform(0, WIDTH, k * tables)) / WIDTH).astype(np.int64)
    odd = rng.integers(1, 1 << 62, k * tables) * 2 + 1
    mixed = (cells * odd).reshape(len(unit), tables, k).sum(2)
    return ((mixed ^ (mixed >> 29)) * 0x5851F42D4C957F2D >> 32).astype(np.int32)


def _unit(vs) -> np.ndarray:
    x = np.array(vs, np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # so that no square overflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _rows_of(column):
    """(row numbers, matrix) of a list column's rows, one for each length."""
    lists = column.combine_chunks()
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    out = []
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        out.append((at, flat[offsets[at][:, None] + np.arange(size)]))
    return out


def _forest(i: list[int], j: list[int]):
    """The pairs that join two trees when added in turn."""
    parent: dict[int, int] = {}
    for p, q in zip(i, j):
        a, b = p, q
        while parent.setdefault(a, a) != a:
            parent[a] = a = parent[parent[a]]
        while parent.setdefault(b, b) != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[b] = a
            yield p, q


def usable(v: str) -> Column:
    """Whether a vector has parts, all of them finite and not all 0."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(v, fits) & F.exists(v, lambda x: x != 0), F.lit(False))


def block_pairs(x: DataFrame, buckets: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``x`` for every pair of blocks that holds their own, with the group ``part`` that compares it.

    ``buckets`` has the size of every bucket (label, t, key). A group takes many small block pairs, about
    GROUP_ROWS rows in all; one pair has about 2 * BLOCK rows.
    """
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = buckets.agg(F.sum(F.col("size") * blocks)).first()[0] or 0  # a row goes to as many pairs as its bucket has blocks
    x = x.join(buckets, ["label", "t", "key"]).withColumn("blocks", blocks.cast("int"))
    x = x.withColumn("own", F.pmod(F.xxhash64("class", F.lit(seed)), F.col("blocks")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.withColumns({"b0": F.least("own", "other"), "b1": F.greatest("own", "other")})
    parts = 1 + int(rows) // GROUP_ROWS
    return x.withColumn("part", F.pmod(F.xxhash64("label", "t", "key", "b0", "b1"), F.lit(parts)))


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    min_cosine: float = 0.98, miss: float = 1e-6, seed: int = 7,
) -> DataFrame:
    """Every row's id, n_links, component_id and kept, for links of cosine ``min_cosine`` or more within a label.

    Vectors that are null, empty, zero, or hold null or non-finite parts link with nothing, as do rows
    with a null label or vectors of another length. Equal vectors are one class with a weight, so copies
    cost nothing beyond the first. A bucket is cut into blocks of about BLOCK classes that are compared
    two at a time, each block pair giving counts and a spanning forest, never its pairs. Rows that share
    an id count as separate vectors; a null id is never the smallest while others are, and its row is kept. Other columns are
    not read.
    """
    kind = vectors.schema[id_col].dataType.simpleString()

    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("class", F.when(F.col("label").isNotNull() & usable("v"), F.xxhash64("label", "v")))
    rows = written(rows.select("id", "label", F.when(F.col("class").isNotNull(), F.col("v")).alias("v"), "class"), "vectors")
    classes = rows.where("class is not null").groupBy("class", "label").agg(F.count("*").alias("weight"), F.first("v").alias("v"))
    classes = written(classes, "vector-classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    k, tables = plan(most, min_cosine, miss)

    def hashed():
        def fn(names, labels, weights, vs):
            keys: list = [None] * len(vs)
            for size in sorted({len(v) for v in vs}):
                own = [i for i, v in enumerate(vs) if len(v) == size]
                for i, row in zip(own, keys_of(_unit([vs[i] for i in own]), k, tables, seed).tolist()):
                    keys[i] = row
            return names, labels, weights, vs, keys

        return fn

    label_kind = vectors.schema[label_col].dataType.simpleString()
    keyed = map_batches(
        classes.select("class", "label", "weight", "v"), hashed,
        f"class bigint, label {label_kind}, weight bigint, v array<double>, keys array<int>",
    )
    keyed = written(keyed, "vector-keys")
    # Buckets are counted and paired by class alone; vectors join the block pairs that need them.
    x = keyed.select("class", "label", F.posexplode("keys").alias("t", "key"))
    slim = written(x.groupBy("label", "t", "key").agg(F.count("*").alias("size")).where("size > 1"), "vector-buckets")
    x = block_pairs(x, slim, seed).join(keyed.select("class", "weight", "v", "keys"), "class")

    def compare(key, batch):
        names, own, weights = (batch[c].to_numpy() for c in ("class", "own", "weight"))
        label = batch["label"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        t, b0, b1 = (batch[c].to_numpy() for c in ("t", "b0", "b1"))
        keys = _rows_of(batch["keys"])[0][1]
        unit, size = np.zeros(len(names), object), np.zeros(len(names), np.int64)
        for at, vs in _rows_of(batch["v"]):
            vs = _unit(vs)
            size[at] = vs.shape[1]
            for i, v in zip(at, vs):
                unit[i] = v
        order = np.lexsort((b1, b0, batch["key"].to_numpy(), t, label, size))
        rank = [c[order] for c in (size, label, t, batch["key"].to_numpy(), b0, b1)]
        starts = np.nonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in rank], axis=0)]))[0]
        links, ea, eb = np.zeros(len(names), np.int64), [], []
        for lo, hi in zip(starts, np.append(starts[1:], len(order))):
            if hi - lo < 2:
                continue
            mine = order[lo:hi]
            same = b0[mine[0]] == b1[mine[0]]
            left = mine if same else mine[own[mine] == b0[mine[0]]]
            right = mine if same else mine[own[mine] == b1[mine[0]]]
            if not len(left) or not len(right):
                continue
            i, j = np.nonzero(np.stack(unit[left]) @ np.stack(unit[right]).T >= min_cosine)
            i, j = left[i], right[j]
            if same:
                i, j = i[i < j], j[i < j]
            if len(i) and t[mine[0]]:  # a pair counts in the first table that brings it together
                fresh = ~np.any(keys[i, : t[mine[0]]] == keys[j, : t[mine[0]]], axis=1)
                i, j = i[fresh], j[fresh]
            if not len(i):
                continue
            np.add.at(links, i, weights[j])
            np.add.at(links, j, weights[i])
            for p, q in _forest(i.tolist(), j.tolist()):
                ea.append(names[p])
                eb.append(names[q])
        some = np.nonzero(links)[0]
        return pa.table({
            "a": np.concatenate([names[some], np.array(ea, np.int64)]),
            "b": pa.array([None] * len(some) + [int(v) for v in eb], pa.int64()),
            "n": np.concatenate([links[some], np.zeros(len(ea), np.int64)]),
        })

    found = x.groupBy("part").applyInArrow(compare, "a bigint, b bigint, n bigint")
    found = written(found, "vector-links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("linked"))
    component = connected_components(found.where("b is not null").select(F.col("a").alias("u"), F.col("b").alias("v")), "vectors")
    per = classes.select("class", "weight").join(counts, F.col("class") == F.col("a"), "left").join(component, F.col("class") == F.col("id"), "left")
    per = per.select("class", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "class").alias("root"))
    out = rows.select("id", "class").join(per, "class", "left")
    out = with_component_id(out)
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
