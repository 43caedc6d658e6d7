"""Points near other points, or in regions, by trapezoidal decomposition, slabs and binary search."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
#: Slabs of points' surroundings are cut into strips of longitude of this width.
STRIP_DEG = 0.05
#: Points of one cell that a task takes on; more crowded cells are shared out, their trapezoids copied.
MOST_POINTS = 20_000
#: Pairs of points and trapezoids looked at, at a time.
CHUNK_PAIRS = 1_000_000
Edges = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def usable_point(lat: F.Column, lon: F.Column) -> F.Column:
    """Whether both coordinates are there, numbers, in range and not both zero."""
    return F.coalesce(~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0)), F.lit(False))


def haversine_m(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, a)))


# -- decomposition -------------------------------------------------------------------
def decompose(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Trapezoids of a simple polygon, rows ``y0, y1, left at y0, left at y1, right at y0, right at y1``.

    The boundary is cut at the height of each corner. Between two heights edges don't cross, so they have an order from left to
    right, and the inside lies between the first and second, the third and fourth, and so on. A sweep holds only the edges
    that reach across the present height.
    """
    x0, y0, x1, y1 = xs, ys, np.roll(xs, -1), np.roll(ys, -1)
    up = y0 < y1
    x0, y0, x1, y1 = np.where(up, x0, x1), np.where(up, y0, y1), np.where(up, x1, x0), np.where(up, y1, y0)
    keep = y0 < y1
    order = np.argsort(y0[keep], kind="stable")
    x0, y0, x1, y1 = (v[keep][order] for v in (x0, y0, x1, y1))
    levels = np.unique(np.concatenate([y0, y1]))
    rows, active, following = [], np.zeros(0, np.int64), 0
    for low, high in zip(levels[:-1], levels[1:], strict=True):
        ahead = int(np.searchsorted(y0, low, side="right"))
        active = np.concatenate([active[y1[active] > low], np.arange(following, ahead)])
        active = active[y1[active] > low]
        following = ahead
        at = lambda y, e=active: x0[e] + (y - y0[e]) * (x1[e] - x0[e]) / (y1[e] - y0[e])
        sorted_edges = np.argsort(at((low + high) / 2), kind="stable")
        bottom, top = at(low)[sorted_edges], at(high)[sorted_edges]
        n = len(active) // 2
        rows.append(np.stack([np.full(n, low), np.full(n, high), bottom[0 : 2 * n : 2], top[0 : 2 * n : 2], bottom[1 : 2 * n : 2], top[1 : 2 * n : 2]], axis=1))
    return np.concatenate(rows) if rows else np.zeros((0, 6))


# -- location ----------------------------------------------------------------------------
def _cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole cells (slab, strip, part), many at a time, of rows sorted by them."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        last = np.ones(len(frame), bool)
        for c in ("slab", "strip", "part"):
            last &= (frame[c] == frame[c].iat[-1]).to_numpy()
        if held and not (last.all() and all(held[-1][c].iat[-1] == frame[c].iat[-1] for c in ("slab", "strip", "part"))):
            yield pd.concat([*held, frame[~last]], ignore_index=True)
            held = []
        elif not last.all():
            yield frame[~last].reset_index(drop=True)
        held.append(frame[last])
    if held:
        yield pd.concat(held, ignore_index=True)


def locate(points: DataFrame, regions: DataFrame, strip: float, edges: Callable[[pd.DataFrame], Edges], found: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame], schema: str, most_points: int = MOST_POINTS) -> DataFrame:
    """Which trapezoids each point lies in.

    Both sides have ``slab`` and ``strip`` (a point one, a trapezoid each that it reaches into) and ``y``, ``x`` of points; other columns
    are carried along. A cell goes to one task; there trapezoids are put in order of their left edges, and a point finds those that may
    hold it by binary search, then tests their two edges. ``edges`` gives the six numbers of trapezoids, ``found`` makes rows of ``schema``
    from a cell's rows and the numbers of points and of their trapezoids.

    A point on a left or lower edge is inside, on a right or upper one outside. Cells of more than ``most_points`` points are
    shared out among tasks; what says which, is at most one row for so many points.
    """
    crowded = points.groupBy("slab", "strip").agg(F.count("*").alias("_n")).where(F.col("_n") > most_points).select("slab", "strip", F.ceil(F.col("_n") / most_points).alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    shared = points.join(F.broadcast(crowded), ["slab", "strip"], "left").withColumn("part", F.pmod(F.xxhash64(*[c for c in points.columns if c not in ("slab", "strip")]), parts)).drop("_parts")
    copied = regions.join(F.broadcast(crowded), ["slab", "strip"], "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))).drop("_parts")
    both = shared.withColumn("_point", F.lit(True)).unionByName(copied.withColumn("_point", F.lit(False)), allowMissingColumns=True)
    placed = both.repartition("slab", "strip", "part").sortWithinPartitions("slab", "strip", "part")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _cells(frames):
            cell = frame.groupby(["slab", "strip", "part"], sort=False).ngroup().to_numpy()
            is_point = frame["_point"].to_numpy(bool)
            p, r = np.flatnonzero(is_point), np.flatnonzero(~is_point)
            if not len(p) or not len(r):
                continue
            y0, y1, left0, left1, right0, right1 = edges(frame.iloc[r])
            # as far as a cell reaches: trapezoids across several strips are cut at its sides
            west = frame["strip"].to_numpy(np.float64)[r] * strip
            left, right = np.clip(np.minimum(left0, left1), west, west + strip), np.clip(np.maximum(right0, right1), west, west + strip)
            order = np.lexsort((left, cell[r]))
            r, y0, y1, left0, left1, right0, right1, left, right = (v[order] for v in (r, y0, y1, left0, left1, right0, right1, left, right))
            widest = np.zeros(cell.max() + 1)
            np.maximum.at(widest, cell[r], right - left)
            # cells lie apart on one axis
            gap = 4 * strip + 1
            axis = cell[r] * gap + (left - frame["strip"].to_numpy(np.float64)[r] * strip)
            x, y = frame["x"].to_numpy(np.float64)[p], frame["y"].to_numpy(np.float64)[p]
            own = cell[p] * gap + (x - frame["strip"].to_numpy(np.float64)[p] * strip)
            lower = np.searchsorted(axis, np.maximum(own - widest[cell[p]] - 1e-9 * strip, cell[p] * gap - strip), side="left")
            upper = np.maximum(lower, np.searchsorted(axis, own + 1e-9 * strip, side="right"))
            ends = np.cumsum(upper - lower)
            start = 0
            while start < len(p):
                floor = ends[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(ends, floor + CHUNK_PAIRS, side="right")))
                n = (upper - lower)[start:end]
                a = np.repeat(np.arange(start, end), n)
                b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lower[start:end], n)
                part = (y[a] - y0[b]) / (y1[b] - y0[b])
                good = (part >= 0) & (part < 1) & (left0[b] + part * (left1[b] - left0[b]) <= x[a]) & (x[a] < right0[b] + part * (right1[b] - right0[b]))
                yield found(frame, p[a[good]], r[b[good]])
                start = end

    return placed.mapInPandas(run, schema)


def _slabs(low: Column, high: Column, height: float) -> Column:
    return F.sequence(F.floor(low / height), F.floor(high / height))


def pairs_within(df: DataFrame, id_col: str, lat: str, lon: str, metres: float, most_points: int = MOST_POINTS) -> DataFrame:
    """``(<id>_a, <id>_b, metres)``, ``a < b``: points at most ``metres`` apart on a sphere, each pair once.

    Around each point lies a region, the box of latitude and longitude that holds all points in reach: one trapezoid with upright
    edges. Points are located in these regions (``locate``), and what the boxes let through is measured exactly. A region is in at most
    two slabs and, but near the poles, two strips; regions reach across the 180th meridian.

    Rows without usable coordinates or id take no part; repeated rows count once; a point is not near itself;
    other columns are not read. An empty table gives an empty table.
    """
    reach = math.degrees(metres / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
    slab = max(2 * reach, 1e-4)
    points = df.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x")).where(usable_point(F.col("y"), F.col("x")) & F.col("id").isNotNull()).dropDuplicates()
    kind = points.schema["id"].dataType.simpleString()
    outer = F.abs("y") + reach
    # near a pole a region goes all around
    half = F.when(outer >= 89.9, 360.0).otherwise(F.degrees(F.asin(F.sin(F.radians(F.lit(reach))) / F.cos(F.radians("y")))) * (1 + 1e-9) + 1e-9)
    home = points.withColumns({"slab": F.floor(F.col("y") / slab), "strip": F.floor(F.col("x") / STRIP_DEG)})
    around = points.withColumn("half", half).withColumn("slab", F.explode(_slabs(F.col("y") - reach, F.col("y") + reach, slab)))
    turn = F.when(F.col("half") >= 360, F.array(F.lit(0.0))).when(F.col("x") - F.col("half") < -180, F.array(F.lit(0.0), F.lit(360.0))).when(F.col("x") + F.col("half") >= 180, F.array(F.lit(0.0), F.lit(-360.0))).otherwise(F.array(F.lit(0.0)))
    turned = around.withColumn("turn", F.explode(turn))
    west, east = F.greatest(F.lit(-180.0), F.col("x") + F.col("turn") - F.col("half")), F.least(F.lit(180.0), F.col("x") + F.col("turn") + F.col("half"))
    regions = turned.withColumn("strip", F.explode(_slabs(west, east, STRIP_DEG)))

    def edges(frame: pd.DataFrame) -> Edges:
        y, x, wide = frame["y"].to_numpy(float), frame["x"].to_numpy(float) + frame["turn"].to_numpy(float), frame["half"].to_numpy(float)
        return y - reach, y + reach, x - wide, x - wide, x + wide, x + wide

    def near(frame: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        ids, y, x = frame["id"].to_numpy(), frame["y"].to_numpy(), frame["x"].to_numpy()
        a, b = (side[ids[b] < ids[a]] for side in (a, b))
        far = haversine_m(y[a], x[a], y[b], x[b])
        good = far <= metres
        return pd.DataFrame({"a": ids[b[good]], "b": ids[a[good]], "metres": far[good]})

    return locate(home, regions, STRIP_DEG, edges, near, f"a {kind}, b {kind}, metres double", most_points).toDF(f"{id_col}_a", f"{id_col}_b", "metres")


def locate_in_regions(points: DataFrame, id_col: str, x: str, y: str, regions: DataFrame, region_col: str, ring: str, slab: float = 0.5, most_points: int = MOST_POINTS) -> DataFrame:
    """``(id_col, region_col)``: the regions that contain each point, by trapezoidal decomposition.

    ``ring`` is an array of ``struct<x double, y double>``, a simple polygon without its last side. Each region is taken apart into
    trapezoids (``decompose``), slabs of ``slab`` in ``y`` and strips of as much in ``x`` are shared out, and points are located there. A
    point on a left or lower edge is inside, on a right or upper one outside. Null, NaN points and rings of under three corners take
    no part; repeated points count once. An empty table on either side gives an empty table.
    """
    pts = points.select(F.col(id_col).alias("pid"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(F.col("pid").isNotNull() & ~F.isnan("x") & ~F.isnan("y") & F.col("x").isNotNull() & F.col("y").isNotNull()).dropDuplicates()
    corners = regions.select(F.col(region_col).alias("rid"), F.transform(ring, lambda c: c.x.cast("double")).alias("xs"), F.transform(ring, lambda c: c.y.cast("double")).alias("ys")).where(F.size("xs") >= 3)
    pid, rid = pts.schema["pid"].dataType.simpleString(), corners.schema["rid"].dataType.simpleString()
    names = ["y0", "y1", "left0", "left1", "right0", "right1"]

    def take_apart(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, xs, ys in frame.itertuples(index=False):
                out = pd.DataFrame(decompose(np.asarray(xs, float), np.asarray(ys, float)), columns=names)
                out.insert(0, "rid", pd.Series([name] * len(out), dtype=frame["rid"].dtype))
                yield out

    shapes = corners.mapInPandas(take_apart, f"rid {rid}, " + ", ".join(f"{n} double" for n in names))
    flat = shapes.withColumn("slab", F.explode(_slabs(F.col("y0"), F.col("y1"), slab))).withColumn("strip", F.explode(_slabs(F.least("left0", "left1"), F.greatest("right0", "right1"), slab)))
    home = pts.withColumns({"slab": F.floor(F.col("y") / slab), "strip": F.floor(F.col("x") / slab), "rid": F.lit("0").try_cast(rid)})
    # no nulls among ids: whole numbers with nulls would travel as floating ones
    flat = flat.withColumn("pid", F.lit("0").try_cast(pid))

    def edges(frame: pd.DataFrame) -> Edges:
        return tuple(frame[n].to_numpy(float) for n in names)

    def inside(frame: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"pid": frame["pid"].to_numpy()[a], "rid": frame["rid"].to_numpy()[b]})

    return locate(home, flat, slab, edges, inside, f"pid {pid}, rid {rid}", most_points).toDF(id_col, region_col)
