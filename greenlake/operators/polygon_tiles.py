"""A tile index of polygons with holes: squares cut in four until a square has few sides.

A square that no side meets is wholly inside, and kept as such, or wholly outside, and dropped. Any other holds the sides
that meet it and what decides about the rest: the parity of the sides to its right, and the heights at which that
parity turns. A point is then tested against its own square's sides alone, by the same even-odd rule and the same
arithmetic as against the whole polygon, so both give the same answer, on the boundary too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from greenlake.functions import geo

_SIDE = "struct<ax: double, ay: double, bx: double, by: double>"
TILE = f"tile_xmin double, tile_ymin double, tile_size double, tile_inside boolean, tile_sides array<{_SIDE}>, tile_odd boolean, tile_turns array<double>"


def _sides(rings) -> np.ndarray:
    parts = [np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2) for ring in rings if ring]
    parts = [np.hstack([r[:-1], r[1:]]) for r in parts if len(r) > 1]
    return np.concatenate(parts) if parts else np.zeros((0, 4))


def _split(sides: np.ndarray, odd: bool, turns: np.ndarray, x: float, y: float, size: float):
    """(sides, parity, turns) of a square within another that has the given ones."""
    ax, ay, bx, by = sides.T
    x1, y1 = x + size, y + size
    near = (np.minimum(ax, bx) <= x1) & (np.maximum(ax, bx) >= x) & (np.minimum(ay, by) <= y1) & (np.maximum(ay, by) >= y)
    # Of the sides whose box meets the square, those pass by that have all corners strictly on one hand.
    hand = [(bx - ax) * (cy - ay) - (by - ay) * (cx - ax) for cx in (x, x1) for cy in (y, y1)]
    slack = 1e-9 * (np.abs(bx - ax) + np.abs(by - ay)) * size
    passes = np.all([h > slack for h in hand], axis=0) | np.all([h < -slack for h in hand], axis=0)
    meets = near & ~passes
    # Others count where they lie to the right at some height of the square; the middle of the shared heights tells.
    low, high = np.maximum(np.minimum(ay, by), y), np.minimum(np.maximum(ay, by), y1)
    level = low < high
    with np.errstate(divide="ignore", invalid="ignore"):
        right = level & ~meets & (((bx - ax) * ((low + high) / 2 - ay) / (by - ay) + ax) > x)
    # A side is crossed at a height that parts its ends; heights met twice cancel, so a run of sides keeps its ends only.
    heights, n = np.unique(np.concatenate([turns, ay[right], by[right]]), return_counts=True)
    heights = heights[n % 2 == 1]
    return sides[meets], odd ^ bool((heights >= y1).sum() % 2), heights[(heights > y) & (heights < y1)]


def squares(rings, size: float, few: int, halvings: int):
    """(x, y, size, inside, sides, odd, turns) of one polygon's squares; those of ``size`` and above stand on multiples of their size."""
    sides = _sides(rings)
    if not len(sides):
        return
    xs, ys = sides[:, [0, 2]], sides[:, [1, 3]]
    step = size
    while max(np.floor(xs.max() / step) - np.floor(xs.min() / step), np.floor(ys.max() / step) - np.floor(ys.min() / step)) > 1:
        step *= 2
    todo = [
        (i * step, j * step, step, sides, False, np.zeros(0))
        for i in range(int(np.floor(xs.min() / step)), int(np.floor(xs.max() / step)) + 1)
        for j in range(int(np.floor(ys.min() / step)), int(np.floor(ys.max() / step)) + 1)
    ]
    while todo:
        x, y, step, sides, odd, turns = todo.pop()
        sides, odd, turns = _split(sides, odd, turns, x, y, step)
        if not len(sides):
            if odd:
                yield x, y, step, True, sides, True, turns
        elif step > size or (len(sides) > few and step > size / 2**halvings):
            half = step / 2
            todo += [(x + dx, y + dy, half, sides, odd, turns) for dx in (0.0, half) for dy in (0.0, half)]
        else:
            yield x, y, step, False, sides, odd, turns


def polygon_tiles(areas: DataFrame, polygon: str, size: float, few: int = 16, halvings: int = 3) -> DataFrame:
    """Areas' other columns with the squares of their polygons: their corner, size, whether inside, and what a test needs.

    Squares of ``size`` are cut further while they have more than ``few`` sides, ``halvings`` times at most. Areas
    without a polygon, and rings of fewer than two points, have no squares. The work lies in the polygons and not in their bytes, so they are
    dealt over all cores.
    """
    rest = [c for c in areas.columns if c != polygon]
    kind = T.StructType([areas.schema[c] for c in rest] + T._parse_datatype_string(TILE).fields)
    out = to_arrow_schema(kind)
    names = [f.name for f in T._parse_datatype_string(_SIDE).fields]

    def cut(batches):
        for batch in batches:
            rows, at = [], []
            for i, rings in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                for x, y, step, inside, sides, odd, turns in squares(rings or [], size, few, halvings):
                    at.append(i)
                    rows.append((x, y, step, inside, [dict(zip(names, s)) for s in sides.tolist()], odd, turns.tolist()))
            kept = batch.take(pa.array(at, pa.int64()))
            cols = [kept.column(k).cast(out.field(k).type) for k in range(len(rest))]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([r[k] for r in rows], out.field(len(rest) + k).type) for k in range(7)], schema=out)

    dealt = areas.select(*rest, F.col(polygon).cast(geo.POLYGON).alias("_polygon")).repartition(areas.sparkSession.sparkContext.defaultParallelism * 4)
    return dealt.mapInArrow(cut, kind)


def bucketed_tiles(tiles: DataFrame, size: float) -> DataFrame:
    """Tiles under the buckets (bx, by) of a grid of ``size``: a larger square under each bucket that it holds, a smaller one under its own."""
    span = lambda c: F.sequence(
        F.floor(F.col(c) / size).cast("long"), F.greatest(F.floor((F.col(c) + F.col("tile_size")) / size - 1), F.floor(F.col(c) / size)).cast("long")
    )
    return tiles.withColumn("bx", F.explode(span("tile_xmin"))).withColumn("by", F.explode(span("tile_ymin")))


def in_tile(x: Column, y: Column) -> Column:
    """Whether a point lies in the tile's square, its right and upper edges excluded, and in the polygon."""
    own = (x >= F.col("tile_xmin")) & (x < F.col("tile_xmin") + F.col("tile_size")) & (y >= F.col("tile_ymin")) & (y < F.col("tile_ymin") + F.col("tile_size"))
    pair = F.transform("tile_sides", lambda s: F.struct(F.struct(s["ax"].alias("x"), s["ay"].alias("y")).alias("a"), F.struct(s["bx"].alias("x"), s["by"].alias("y")).alias("b")))
    crossed = F.size(F.filter(pair, lambda s: geo.crosses(s, x, y))) + F.size(F.filter("tile_turns", lambda t: t > y)) + F.col("tile_odd").cast("int")
    return own & (F.col("tile_inside") | (crossed % 2 == 1) | F.exists(pair, lambda s: geo.touches(s, x, y)))


def clipped(tiles: DataFrame, areas: DataFrame, polygon: str, key: str) -> DataFrame:
    """Tiles with the polygon's part in each square (``tile_polygon``) and its area (``tile_area_m2``), for stored boundary tiles.

    A hole's part is a ring of its own; where a part falls apart, its pieces hang together along the square's edge.
    """
    box = geo.box_polygon("tile_xmin", "tile_ymin", F.col("tile_xmin") + F.col("tile_size"), F.col("tile_ymin") + F.col("tile_size"))
    rings = F.array_compact(F.transform(F.col("_polygon"), lambda r: geo.clip_to_convex(r, box[0])))
    part = F.when(F.col("tile_inside"), box).otherwise(rings)
    x = tiles.join(areas.select(key, F.col(polygon).cast(geo.POLYGON).alias("_polygon")), key).withColumn("tile_polygon", part)
    return x.withColumn("tile_area_m2", geo.polygon_area(F.col("tile_polygon"))).drop("_polygon", "tile_sides", "tile_odd", "tile_turns")
