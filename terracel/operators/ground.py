"""Noise flags and ground filters for point clouds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..core.grid import cell
from ..core.knn import mean_nearest
from ..core.lineage import cut
from ..core.skew import salted_join
from .raster import complete, focal, neighbours

# fixed values: presets of the slope-based filter
PRESETS = {
    "town": {"slope": 0.20, "scalar": 1.20, "threshold": 0.45, "window": 18.0},
    "nature": {"slope": 0.15, "scalar": 1.25, "threshold": 0.50, "window": 16.0},
}


def low_noise(points: DataFrame, size: float = 10.0, threshold: float = 1.0, tile: str = "tile_id") -> DataFrame:
    """Adds ``noise``: the lowest point of a cell when the next one is more than ``threshold`` higher.

    The two lowest points per cell are picked before the shuffle already (rank limit).
    """
    keyed = points.withColumn("_cx", cell(F.col("x"), size)).withColumn("_cy", cell(F.col("y"), size))
    place = [tile, "_cx", "_cy"]  # pids may repeat over tiles
    w = Window.partitionBy(*place).orderBy("z", "pid")
    two = keyed.select(*place, "z", "pid").withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= 2)
    gap = two.groupBy(*place).agg(
        F.max(F.when(F.col("_k") == 1, F.col("pid"))).alias("pid"),
        (F.max(F.when(F.col("_k") == 2, F.col("z"))) - F.max(F.when(F.col("_k") == 1, F.col("z")))).alias("_gap"))
    flagged = gap.filter(F.col("_gap") > threshold).select(tile, "pid", F.lit(True).alias("noise")).distinct()
    return salted_join(points, flagged, [tile, "pid"], ["pid"], "left").withColumn("noise", F.coalesce("noise", F.lit(False)))


def mean_neighbour_distance(points: DataFrame, k: int = 12) -> DataFrame:
    """``x, y, z, copies, mean_d``: mean distance to the ``k`` nearest other points in space.

    Copies of a position are one row with a count (they are neighbours at distance 0).  The search goes through
    a tree of cells (``core.knn``), so that neither crowds nor lonely points meet more than they need to.
    """
    every = cut(points.groupBy("x", "y", "z").agg(F.count(F.lit(1)).alias("copies")))
    # a coordinate that is missing or no number has no distance to anything
    placed = F.lit(True)
    for c in "xyz":
        placed = placed & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    spots, odd = every.filter(placed), every.filter(~placed).withColumn("mean_d", F.lit(None).cast("double"))
    total = spots.agg(F.sum("copies")).first()[0] or 0
    need = min(k, total - 1)
    if need <= 0:
        return spots.withColumn("mean_d", F.lit(0.0)).unionByName(odd)
    doubles = spots.select(*[F.col(c).cast("double").alias(c) for c in "xyz"], "copies")
    found = mean_nearest(doubles, need)
    return found.select(*[F.col(c).cast(points.schema[c].dataType).alias(c) for c in "xyz"], "copies", "mean_d").unionByName(odd)


def statistical_outliers(points: DataFrame, k: int = 12, mult: float = 2.5) -> DataFrame:
    """Adds ``noise``: mean distance to ``k`` neighbours above the global mean plus ``mult`` deviations."""
    m = cut(mean_neighbour_distance(points, k))
    n, s = F.sum(F.when(F.col("mean_d").isNotNull(), F.col("copies"))), F.sum(F.col("copies") * F.col("mean_d"))
    ss = F.sum(F.col("copies") * F.col("mean_d") * F.col("mean_d"))
    limit = m.agg((s / n + mult * F.sqrt(F.greatest((ss - s * s / n) / F.greatest(n - 1, F.lit(1)), F.lit(0.0)))).alias("_lim"))
    noisy = F.coalesce(F.col("mean_d") > F.col("_lim"), F.lit(False))
    far = m.crossJoin(F.broadcast(limit)).select("x", "y", "z", noisy.alias("noise"))  # one-row side
    out = salted_join(points, far, ["x", "y", "z"], ["pid"], "left")
    return out.withColumn("noise", F.coalesce("noise", F.lit(False)))  # a null coordinate joins nothing


def pmf_parameters(size: float, building: float, angle: float, distance: float) -> dict:
    """Filter parameters from building size, terrain angle and distance: odd window, slope by tangent."""
    window = max(3, int(round(building / max(size, 0.01))))
    window += window % 2 == 0
    return {
        "size": size, "slope": max(0.01, math.tan(math.radians(max(0.1, angle)))),
        "initial": max(0.05, distance * 0.2), "max_distance": max(0.1, distance), "max_window": window,
    }


def _lowest(points: DataFrame, size: float, tile: str, reach: int) -> DataFrame:
    """Lowest point of each cell, with the holes that openings of ``reach`` cells in all may look at."""
    low = points.groupBy(tile, cell(F.col("y"), size).alias("row_i"), cell(F.col("x"), size).alias("col_i")).agg(F.min("z").alias("v"))
    return complete(low, [tile], reach=reach)


def _opened(grid: DataFrame, half: int, tile: str) -> DataFrame:
    """Erosion then dilation of ``v`` as ``o``."""
    return focal(focal(grid, half, "min", [tile], "v", "_f"), half, "max", [tile], "_f", "o").drop("_f")


def ground_pmf(
    points: DataFrame, size: float, slope: float, initial: float, max_distance: float, max_window: int,
    exponential: bool = True, tile: str = "tile_id",
) -> DataFrame:
    """Progressive morphological filter: adds ``ground``.

    Each round opens the last surface with a wider window; a point stays ground while it lies less
    than the round's threshold above the opened surface.
    """
    windows, k = [], 1
    while True:
        w = 2**k + 1 if exponential else 2 * k + 1
        if w > max_window:
            break
        windows.append(w)
        k += 1
    reach = sum(2 * (w // 2) for w in windows or [3])
    grid = _lowest(points, size, tile, reach).select(tile, "row_i", "col_i", "v")
    limits = None
    before = 0
    for i, w in enumerate(windows or [3]):
        t = initial if i == 0 else min(max_distance, slope * (w - before) * size + initial)
        before = w
        grid = _opened(grid, w // 2, tile).withColumn("_cap", F.col("o") + t)
        # a point must stay below every round's limit: the lowest one decides
        grid = grid.withColumn("cap", F.col("_cap") if limits is None else F.least("cap", "_cap"))
        limits = True
        grid = cut(grid.select(tile, "row_i", "col_i", F.col("o").alias("v"), "cap"))
    return _below(points, grid, size, tile)


def _below(points: DataFrame, grid: DataFrame, size: float, tile: str) -> DataFrame:
    keyed = points.withColumn("row_i", cell(F.col("y"), size)).withColumn("col_i", cell(F.col("x"), size))
    return salted_join(keyed, grid.select(tile, "row_i", "col_i", "cap"), [tile, "row_i", "col_i"], ["pid"]).withColumn(
        "ground", F.col("z") < F.col("cap")).drop("row_i", "col_i", "cap")


def ground_smrf(
    points: DataFrame, size: float, slope: float, scalar: float, threshold: float, window: float,
    tile: str = "tile_id",
) -> DataFrame:
    """Slope-based morphological filter: adds ``ground``.

    Cells whose lowest point rises above an opened surface by more than slope times radius are
    objects and take the opened height; points are ground within ``threshold`` plus ``scalar``
    times the local slope of that surface.
    """
    radii = range(1, max(1, math.ceil(window / size)) + 1)
    grid = _lowest(points, size, tile, 2 * sum(radii) + 1).select(tile, "row_i", "col_i", "v", F.col("v").alias("last"))
    for radius in radii:
        g = _opened(grid.withColumn("v", F.col("last")), radius, tile)
        tall = (F.col("last") - F.col("o")) > slope * radius * size
        g = g.withColumn("last", F.when(tall | F.col("last").isNull(), F.col("o")).otherwise(F.col("last")))
        grid = cut(g.select(tile, "row_i", "col_i", "v", "last"))
    n = neighbours(grid.select(tile, "row_i", "col_i", F.col("last").alias("v")), [tile])
    dx, dy = (F.col("e") - F.col("w")) / (2 * size), (F.col("s") - F.col("n")) / (2 * size)
    steep = F.coalesce(F.hypot(dx, dy), F.lit(0.0))
    surface = n.select(tile, "row_i", "col_i", (F.col("v") + threshold + scalar * steep).alias("cap"))
    return _below(points, surface, size, tile)


def classify_ground(points: DataFrame, size: float, algorithm: str = "pmf", preset: str = "town", drop_noise: bool = True, **params) -> DataFrame:
    """Last returns, noise out, ground filter: ground points with class 2."""
    from .points import assign_class, class_range, return_filter

    p = return_filter(points, "last_only")
    if drop_noise:
        p = low_noise(p).filter(~F.col("noise")).drop("noise")
        p = statistical_outliers(p).filter(~F.col("noise")).drop("noise")
        p = class_range(p, 7, 7, exclude=True)
    if algorithm == "smrf":
        g = ground_smrf(p, size, **PRESETS[preset])
    else:
        g = ground_pmf(p, **pmf_parameters(size, **(params or {"building": 33.0 * size, "angle": 8.0, "distance": 1.0})))
    return assign_class(g.filter("ground").drop("ground"), 2)
