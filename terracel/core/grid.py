"""Grid-keyed spatial joins: equi-joins on cells, exact predicate afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut
from .skew import exploded, exploded_if_many, salted_join


def cell(x: Column, size) -> Column:
    """Index of the grid cell holding ``x``."""
    return F.floor(x / F.lit(size)).cast("long")


def cover(df: DataFrame, minx, miny, maxx, maxy, size: float, cx="_cx", cy="_cy") -> DataFrame:
    """One row per grid cell that the box touches."""
    return df.withColumn(cx, F.explode(F.sequence(cell(minx, size), cell(maxx, size)))).withColumn(
        cy, F.explode(F.sequence(cell(miny, size), cell(maxy, size)))
    )


def pairs_within(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_xy: Sequence[str],
    right_xy: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs with planar distance ``_d <= radius`` and equal ``keys``.

    The left row keeps its own cell and only the right side is repeated over the cells
    around it, so no pair appears twice and nothing has to be deduplicated.
    """
    lx, ly = (F.col(c) for c in left_xy)
    rx, ry = (F.col(c) for c in right_xy)
    a = left.withColumn("_cx", cell(lx, radius)).withColumn("_cy", cell(ly, radius))
    b = exploded(cover(right, rx - radius, ry - radius, rx + radius, ry + radius, radius))
    joined = salted_join(a, b, [*keys, "_cx", "_cy"], spread, how)
    d = F.hypot(lx - rx, ly - ry)
    joined = joined.withColumn("_d", d).drop("_cx", "_cy")
    return joined.filter(F.col("_d") <= radius) if how == "inner" else joined


def points_in_boxes(
    points: DataFrame,
    boxes: DataFrame,
    xy: Sequence[str],
    box: Sequence[str],
    size: float,
    spread: Sequence[str],
) -> DataFrame:
    """Points paired with every box (closed bounds) that holds them."""
    x, y = (F.col(c) for c in xy)
    minx, miny, maxx, maxy = (F.col(c) for c in box)
    a = points.withColumn("_cx", cell(x, size)).withColumn("_cy", cell(y, size))
    b = exploded_if_many(cover(boxes, minx, miny, maxx, maxy, size))
    joined = salted_join(a, b, ["_cx", "_cy"], spread).drop("_cx", "_cy")
    return joined.filter((x >= minx) & (x <= maxx) & (y >= miny) & (y <= maxy))


def box_pairs(
    left: DataFrame,
    right: DataFrame,
    left_box: Sequence[str],
    right_box: Sequence[str],
    size: float,
    spread: Sequence[str],
    pad: float = 0.0,
    few: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs of boxes with equal ``keys`` that touch when the right ones grow by ``pad``; ``few`` where one side has few boxes at any size.

    A pair may meet in many cells; it is kept only in the cell of the lower-left corner of
    the common part, which needs no deduplication shuffle.
    """
    la, lb, lc, ld = (F.col(c) for c in left_box)
    ra, rb, rc, rd = (F.col(c) for c in right_box)
    ra, rb, rc, rd = ra - pad, rb - pad, rc + pad, rd + pad
    a = cover(left, la, lb, lc, ld, size)
    b = cover(right, ra, rb, rc, rd, size)
    joined = salted_join(a, b if few else exploded(b), [*keys, "_cx", "_cy"], spread)
    touch = (la <= rc) & (ra <= lc) & (lb <= rd) & (rb <= ld)
    home = (F.col("_cx") == cell(F.greatest(la, ra), size)) & (
        F.col("_cy") == cell(F.greatest(lb, rb), size)
    )
    return joined.filter(touch & home).drop("_cx", "_cy")


def nearest(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_id: str,
    right_id: str,
    left_xy: Sequence[str] = ("x", "y"),
    right_xy: Sequence[str] = ("rx", "ry"),
    dense: int = 2_000,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``left_id, right_id, dist``: the closest right point within ``radius``, lowest id on ties.

    Only points with equal ``keys`` meet, and the result carries the keys.
    Copies of one right position are merged first.  When some cell of side ``radius``
    still holds more than ``dense`` right points, candidate cells are narrowed level by
    level (each level halves the side): a left point keeps only the occupied cells that may
    still hold its closest point, so a crowded cell is never compared in full.
    """
    lx, ly = left_xy
    rx, ry = right_xy
    keys = list(keys)
    pts = left.select(*keys, left_id, F.col(lx).alias("_lx"), F.col(ly).alias("_ly"))
    spots = (
        right.groupBy(*keys, F.col(rx).alias("_rx"), F.col(ry).alias("_ry"))
        .agg(F.min(right_id).alias(right_id))
    )
    spots = cut(spots)
    size, levels = radius, 0
    while levels < 24:
        busiest = (
            spots.groupBy(*keys, cell(F.col("_rx"), size).alias("_i"), cell(F.col("_ry"), size).alias("_j"))
            .count().agg(F.max("count")).first()[0]
        )
        if (busiest or 0) <= dense:
            break
        size, levels = size / 2, levels + 1
    if levels == 0:
        near = pairs_within(pts, spots, radius, ("_lx", "_ly"), ("_rx", "_ry"), [left_id], keys=keys)
    else:
        near = _narrow(pts, spots, radius, levels, left_id, right_id, keys)
    best = near.groupBy(*keys, left_id).agg(F.min(F.struct("_d", right_id)).alias("_b"))
    return best.select(*keys, left_id, F.col(f"_b.{right_id}").alias(right_id), F.col("_b._d").alias("dist"))


def _narrow(pts, spots, radius, levels, left_id, right_id, keys):
    def occupied(side):
        return spots.select(
            *keys, cell(F.col("_rx"), side).alias("_cx"), cell(F.col("_ry"), side).alias("_cy")
        ).distinct()

    def far(side):  # farthest corner of the cell
        dx = F.greatest(F.abs(F.col("_lx") - F.col("_cx") * side), F.abs(F.col("_lx") - (F.col("_cx") + 1) * side))
        dy = F.greatest(F.abs(F.col("_ly") - F.col("_cy") * side), F.abs(F.col("_ly") - (F.col("_cy") + 1) * side))
        return F.hypot(dx, dy)

    def close(side):  # closest position of the cell
        dx = F.greatest(F.col("_cx") * side - F.col("_lx"), F.col("_lx") - (F.col("_cx") + 1) * side, F.lit(0.0))
        dy = F.greatest(F.col("_cy") * side - F.col("_ly"), F.col("_ly") - (F.col("_cy") + 1) * side, F.lit(0.0))
        return F.hypot(dx, dy)

    slack = radius * 1e-9
    cand = cover(pts, F.col("_lx") - radius, F.col("_ly") - radius,
                 F.col("_lx") + radius, F.col("_ly") + radius, radius)
    side = radius
    for level in range(levels + 1):
        if level:
            side = side / 2
            for axis in ("_cx", "_cy"):
                cand = cand.withColumn(axis, F.explode(F.array(F.col(axis) * 2, F.col(axis) * 2 + 1)))
        cand = cand.join(occupied(side), [*keys, "_cx", "_cy"], "left_semi")
        bound = cand.groupBy(*keys, left_id).agg(
            F.collect_list(F.struct("_cx", "_cy", close(side).alias("near"))).alias("_cells"),
            F.min(far(side)).alias("_far"), F.first("_lx").alias("_lx"), F.first("_ly").alias("_ly"),
        )
        limit = F.least(F.col("_far"), F.lit(radius)) + slack
        cand = cut(bound.select(
            *keys, left_id, "_lx", "_ly",
            F.explode(F.filter("_cells", lambda c: c["near"] <= limit)).alias("_c"),
        ).select(*keys, left_id, "_lx", "_ly", F.col("_c._cx").alias("_cx"), F.col("_c._cy").alias("_cy")))
    members = spots.withColumn("_cx", cell(F.col("_rx"), side)).withColumn("_cy", cell(F.col("_ry"), side))
    joined = salted_join(cand, members, [*keys, "_cx", "_cy"], [left_id])
    d = F.hypot(F.col("_lx") - F.col("_rx"), F.col("_ly") - F.col("_ry"))
    return joined.withColumn("_d", d).filter(F.col("_d") <= radius).select(*keys, left_id, right_id, "_d")
