"""Point, line and polygon joins.

Polygon tables carry an open ``ring`` (``array<struct<x,y>>``); lines come as segments
``x1, y1, x2, y2``.  All joins are equi-joins on grid cells with the exact test afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.grid import box_pairs, cell, cover
from ..core.skew import exploded_if_many, salted_join
from ..functions import geometry as G
from .overlay import overlay_sums, points_in_features

BOX = ("minx", "miny", "maxx", "maxy")
ENDS = ("x1", "y1", "x2", "y2")


def with_box(features: DataFrame, ring: str = "ring", pad: float = 0.0) -> DataFrame:
    """Adds the bounding box columns of the ring."""
    box = G.ring_box(F.col(ring))
    sign = {"minx": -pad, "miny": -pad, "maxx": pad, "maxy": pad}
    return features.withColumns({c: box[c] + sign[c] for c in BOX})


def with_ring(boxes: DataFrame) -> DataFrame:
    """Adds the counter-clockwise ring of box columns."""
    return boxes.withColumn("ring", G.box_ring(*[F.col(c) for c in BOX]))


def min_area(features: DataFrame, area: float, ring: str = "ring") -> DataFrame:
    """Drop slivers smaller than ``area``."""
    return features.filter(G.ring_area(F.col(ring)) >= area)


def points_near_polygons(
    points: DataFrame, polys: DataFrame, reach: float, size: float, point_id: str,
    xy: Sequence[str] = ("x", "y"), spread: Sequence[str] | None = None,
) -> DataFrame:
    """Point and polygon pairs with ``_in`` (inside) and ``_d`` (0 inside, else edge distance) <= reach.

    Polygons that are their own boxes are told apart once a polygon; their edges are not gone through for every point.
    """
    x, y = (F.col(c) for c in xy)
    plain = with_box(polys, pad=reach).withColumn("_box", F.when(G.is_box(F.col("ring")), G.ring_box(F.col("ring"))))
    laid = exploded_if_many(cover(plain, *[F.col(c) for c in BOX], size))
    keyed = points.withColumn("_cx", cell(x, size)).withColumn("_cy", cell(y, size))
    near = salted_join(keyed, laid, ["_cx", "_cy"], spread or [point_id]).filter(
        x.between(F.col("minx"), F.col("maxx")) & y.between(F.col("miny"), F.col("maxy"))
    )
    # as a generated row: columns that a filter uses and later steps read again would be worked out for every use
    tested = F.transform(F.array(G.point_in_ring(x, y, F.col("ring"))), lambda i: F.struct(
        i.alias("_in"), F.when(i, 0.0).otherwise(G.ring_distance(x, y, F.col("ring"))).alias("_d")))
    kept = F.filter(tested, lambda t: t["_in"] | (t["_d"] <= reach))
    b = {c: F.col("_box")[c] for c in BOX}
    away = F.hypot(F.greatest(b["minx"] - x, x - b["maxx"], F.lit(0.0)), F.greatest(b["miny"] - y, y - b["maxy"], F.lit(0.0)))
    held = (x >= b["minx"]) & (x < b["maxx"]) & (y >= b["miny"]) & (y < b["maxy"])  # as edges would be crossed
    boxed = F.array(F.struct(held.alias("_in"), away.alias("_d")))
    kept = F.when(F.col("_box").isNull(), kept).when(away <= reach, boxed)
    near = near.select(*[F.col(c) for c in near.columns if c not in ("_cx", "_cy", "_box", *BOX)], F.explode(kept).alias("_t"))
    return near.select("*", "_t._in", "_t._d").drop("_t")


def points_in_polygons(
    points: DataFrame, polys: DataFrame, size: float, point_id: str, xy: Sequence[str] = ("x", "y"),
) -> DataFrame:
    """Points paired with every polygon that contains them (boundary included)."""
    return points_near_polygons(points, polys, 1e-9, size, point_id, xy).drop("_in", "_d", "ring")


def points_in_mask(
    points: DataFrame, mask: DataFrame, size: float, point_id: str, mode: str = "covers",
    buffer: float = 0.0, xy: Sequence[str] = ("x", "y"),
) -> DataFrame:
    """Points within, covered by or touching a mask grown (or shrunk) by ``buffer``.

    ``within`` leaves out the boundary, ``covers`` and ``intersects`` keep it.
    """
    rings = mask.select("ring")
    x, y = (F.col(c) for c in xy)
    ids = points.select(point_id, *xy)
    near = points_near_polygons(ids, rings, max(buffer, 0.0) + 1e-9, size, point_id, xy)
    edge = G.ring_distance(x, y, F.col("ring"))
    eps = 1e-9
    if buffer > 0:
        ok = F.col("_in") | (F.col("_d") < buffer if mode == "within" else F.col("_d") <= buffer)
    elif buffer < 0:
        ok = F.col("_in") & (edge > -buffer if mode == "within" else edge >= -buffer)
    else:
        ok = (F.col("_in") & (edge > eps)) if mode == "within" else (F.col("_in") | (F.col("_d") <= eps))
    hits = near.filter(ok).select(point_id).distinct()
    return salted_join(points, hits, [point_id], [point_id], "left_semi")


def clip_lines(lines: DataFrame, polys: DataFrame, size: float) -> DataFrame:
    """Text lines ``path, seq, value``: coordinates outside the polygons go, other lines stay.

    A coordinate line starts with two numbers.
    """
    parts = F.split(F.trim("value"), r"[\s;,]+")
    parsed = lines.withColumn("_x", F.get(parts, F.lit(0)).try_cast("double")).withColumn(
        "_y", F.get(parts, F.lit(1)).try_cast("double")
    ).withColumn("_id", F.struct("path", "seq"))
    is_point = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    inside = points_in_mask(parsed.filter(is_point), polys, size, "_id", xy=("_x", "_y"))
    return inside.unionByName(parsed.filter(~is_point)).select("path", "seq", "value", is_point.alias("is_point"))


def clip_counts(lines: DataFrame, kept: DataFrame) -> DataFrame:
    """Kept and total coordinate lines per file."""
    parts = F.split(F.trim("value"), r"[\s;,]+")
    is_point = F.get(parts, F.lit(0)).try_cast("double").isNotNull() & F.get(parts, F.lit(1)).try_cast("double").isNotNull()
    total = lines.groupBy("path").agg(F.count_if(is_point).alias("total"))
    kept_n = kept.groupBy("path").agg(F.count_if("is_point").alias("kept"))
    return total.join(kept_n, "path", "left").withColumn("kept", F.coalesce("kept", F.lit(0)))


def tiles_for_polygons(polys: DataFrame, tiles: DataFrame, poly_id: str, tile_id: str, pad: float, size: float) -> DataFrame:
    """Tiles whose box meets each polygon's padded box; polygons without any get status ``no_tiles``."""
    p = with_box(polys).select(poly_id, *[F.col(c).alias(f"p_{c}") for c in BOX])
    t = tiles.select(tile_id, *BOX)
    hits = box_pairs(t, p, BOX, [f"p_{c}" for c in BOX], size, [tile_id], pad, few=True).select(poly_id, tile_id)
    out = polys.select(poly_id).join(hits, poly_id, "left")
    return out.withColumn("status", F.when(F.col(tile_id).isNull(), "no_tiles").otherwise("ok"))


def crop_points(
    points: DataFrame, polys: DataFrame, size: float, poly_id: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Points inside each polygon; ``keys`` (lot, block) must agree after normalising.

    Filter the result by class for the classed and ground products: all three share this join.
    Polygons may have ``holes``, or ``parts`` with holes, instead of one ``ring``.
    """
    from ..functions.text import normal_key

    shape = [c for c in ("ring", "holes", "parts") if c in polys.columns]
    p = polys.select(poly_id, *shape, *[normal_key(F.col(k).cast("string")).alias(f"_p_{k}") for k in keys])
    if shape == ["ring"]:
        out = points_in_polygons(points, p, size, "pid")
    else:
        out = points_in_features(points, p, size, "pid", [poly_id, *[f"_p_{k}" for k in keys]])
    for k in keys:
        out = out.filter(normal_key(F.col(k).cast("string")) == F.col(f"_p_{k}"))
    return out.drop(*[f"_p_{k}" for k in keys])


def containing_polygon(
    points: DataFrame, polys: DataFrame, size: float, point_id: str, poly_id: str,
    key: Sequence[str] | None = None, fallback: Column | None = None,
) -> DataFrame:
    """Polygon holding each point (lowest id), optionally of the same key; else the fallback name."""
    cols = [poly_id, "ring"] + ([key[1]] if key else [])
    hit = points_in_polygons(points.select(point_id, "x", "y", *([key[0]] if key else [])), polys.select(*cols), size, point_id)
    if key:
        hit = hit.filter(F.col(key[0]) == F.col(key[1]))
    best = hit.groupBy(point_id).agg(F.min(poly_id).alias(poly_id))
    out = salted_join(points, best, [point_id], [point_id], "left")
    return out if fallback is None else out.withColumn(poly_id, F.coalesce(F.col(poly_id), fallback))


def admin_unit(
    features: DataFrame, units: DataFrame, size: float, fid: str, unit_id: str, districts: dict[str, str]
) -> DataFrame:
    """Unit holding the centroid of each feature and the district looked up from it."""
    c = G.ring_centroid(F.col("ring"))
    cents = features.select(fid, c["x"].alias("x"), c["y"].alias("y"))
    found = containing_polygon(cents, units, size, fid, unit_id).select(fid, unit_id)
    pairs = F.create_map(*[F.lit(v) for kv in districts.items() for v in kv])
    return found.withColumn("district", F.try_element_at(pairs, F.col(unit_id)))


def nearest_lot(
    points: DataFrame, lots: DataFrame, point_id: str, lot_id: str, buffer: float = 0.2,
    max_dist: float = 5.0, size: float = 10.0,
) -> DataFrame:
    """Closest lot of each point: inside or within ``buffer`` counts 0, limit ``max_dist``, lowest id on ties."""
    cand = lot_candidates(points, lots, point_id, lot_id, buffer, max_dist, size)
    best = cand.groupBy(point_id).agg(F.min(F.struct("dist", lot_id)).alias("_b"))
    return best.select(point_id, F.col(f"_b.{lot_id}").alias(lot_id), F.col("_b.dist").alias("dist"))


def lot_candidates(points, lots, point_id, lot_id, buffer, max_dist, size) -> DataFrame:
    """All lots within ``max_dist`` of each point with the distance used for choosing."""
    near = points_near_polygons(points.select(point_id, "x", "y"), lots.select(lot_id, "ring"), max(max_dist, buffer), size, point_id)
    d = F.when(F.col("_d") <= buffer, 0.0).otherwise(F.col("_d"))
    return near.select(point_id, lot_id, d.alias("dist"))


def largest_building(lots: DataFrame, buildings: DataFrame, lot_id: str, building_id: str, size: float) -> DataFrame:
    """Building with the largest shared area in each lot: ``lot_id, building_id, area``.

    Areas are rounded to 1e-6 before they are compared; of equal ones the lowest id wins.
    """
    pairs = overlay_sums(lots, buildings, lot_id, building_id, size).withColumn("area", F.round("area", 6)).filter("area > 1e-6")
    best = pairs.groupBy(lot_id).agg(F.max(F.struct(F.col("area"), (-F.col(building_id)).alias("_i"), building_id)).alias("_b"))
    return best.select(lot_id, F.col(f"_b.{building_id}").alias(building_id), F.col("_b.area").alias("area"))


def largest_inner_building(lots: DataFrame, buildings: DataFrame, lot_id: str, building_id: str, size: float) -> DataFrame:
    """Largest building whose centroid lies in the lot."""
    c = G.ring_centroid(F.col("ring"))
    b = buildings.select(building_id, c["x"].alias("x"), c["y"].alias("y"), G.ring_area(F.col("ring")).alias("area"))
    hit = points_in_polygons(b, lots.select(lot_id, "ring"), size, building_id)
    best = hit.groupBy(lot_id).agg(F.max(F.struct("area", (-F.col(building_id)).alias("_i"), building_id)).alias("_b"))
    return best.select(lot_id, F.col(f"_b.{building_id}").alias(building_id), F.col("_b.area").alias("area"))


def road_name_at(points: DataFrame, roads: DataFrame, point_id: str, name: str, max_dist: float = 15.0) -> DataFrame:
    """Name of the closest line within ``max_dist`` of each point."""
    from .flight import nearest_line

    return nearest_line(points, roads.filter(F.col(name).isNotNull() & (F.col(name) != "")), max_dist, point_id, name)


def local_direction(
    points: DataFrame, lines: DataFrame, point_id: str, radius: float, delta: float = 0.1, missing: float | None = 0.0
) -> DataFrame:
    """Direction (0..360, from x axis) of the closest segment at the projected point.

    ``missing`` (0 for roads, null for lot edges) where nothing is within ``radius`` or the
    point projects on the very end.
    """
    from .flight import cells_along

    laid = cells_along(lines.select(*ENDS).distinct(), radius)
    keyed = points.select(point_id, "x", "y").withColumn("_cx", cell(F.col("x"), radius)).withColumn("_cy", cell(F.col("y"), radius))
    ends = [F.col(c) for c in ENDS]
    near = salted_join(keyed, laid, ["_cx", "_cy"], [point_id]).withColumn(
        "_d", G.segment_distance(F.col("x"), F.col("y"), *ends)
    ).filter(F.col("_d") <= radius)
    best = near.groupBy(point_id, "x", "y").agg(F.min(F.struct("_d", *ends)).alias("_b"))
    b = [F.col(f"_b.{c}") for c in ENDS]
    t = G.project_fraction(F.col("x"), F.col("y"), *b)
    n = F.hypot(b[2] - b[0], b[3] - b[1])
    step = F.least(t * n + delta, n) - t * n
    angle = F.pmod(F.degrees(F.atan2(b[3] - b[1], b[2] - b[0])), F.lit(360.0))
    found = best.select(point_id, F.when(step > 0, angle).alias("angle"))
    return salted_join(points.select(point_id), found, [point_id], [point_id], "left").withColumn(
        "angle", F.coalesce("angle", F.lit(missing).cast("double"))
    )


def footprint_overlaps(fps: DataFrame, fid: str, size: float, pad: float = 0.0, mode: str = "bbox") -> DataFrame:
    """Pairs ``a < b`` of footprints that meet, by box or by convex hull ``ring``.

    With a pad the hull test keeps hulls no farther than the pad; pad 0 is edge contact or
    containment.  Hulls that are their own boxes are told apart once a footprint; two of them
    meet as their boxes do, so edges are compared only for pairs with another hull.
    """
    def pairs(left, right, *extra):
        a = left.select(F.col(fid).alias("a"), *extra, *BOX)
        b = right.select(F.col(fid).alias("b"), *[F.col(c).alias(f"_{c}") for c in (*extra, *BOX)])
        return box_pairs(a, b, BOX, [f"_{c}" for c in BOX], size, ["a"], pad).filter(F.col("a") < F.col("b"))

    if mode == "bbox":
        return pairs(fps, fps).select("a", "b")
    base = with_box(fps)
    plain = G.is_box(F.col("ring"))
    boxes, others = base.filter(plain), base.filter(~plain)
    met = pairs(boxes, boxes)
    if pad > 0:
        apart = lambda lo, hi: F.greatest(F.col(f"_{lo}") - F.col(hi), F.col(lo) - F.col(f"_{hi}"), F.lit(0.0))
        met = met.filter(F.hypot(apart("minx", "maxx"), apart("miny", "maxy")) <= pad)
    met = met.select("a", "b")
    if others.isEmpty():
        return met
    mixed = pairs(others, base, "ring").unionByName(pairs(boxes, others, "ring"))
    return met.unionByName(mixed.filter(hulls_meet(F.col("ring"), F.col("_ring"), pad)).select("a", "b"))


def hulls_meet(p: Column, q: Column, pad: float) -> Column:
    """Edges touch (or come within ``pad``) or one hull holds the other."""
    def close(e, o):
        args = [e[c] for c in ENDS] + [o[c] for c in ENDS]
        return G.segments_cross(*args) if pad <= 0 else G.segment_gap(*args) <= pad

    edges = F.exists(G.ring_edges(p), lambda e: F.exists(G.ring_edges(q), lambda o: close(e, o)))
    first = lambda r: F.element_at(r, 1)
    return edges | G.point_in_ring(first(p)["x"], first(p)["y"], q) | G.point_in_ring(first(q)["x"], first(q)["y"], p)


def _usual_size(left: DataFrame, right: DataFrame, most: int = 64) -> float:
    """Cell size between the usual sizes of the boxes of two tables; no box spans more than ``most`` cells (runs a job on each)."""
    side = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    (m, x), (n, y) = (df.agg(F.coalesce(F.avg(side), F.lit(0.0)), F.coalesce(F.max(side), F.lit(0.0))).first() for df in (left, right))
    return max((m * n) ** 0.5, x / most, y / most) or 1.0


def clip_geometry_for(rasters: DataFrame, sheets: DataFrame) -> DataFrame:
    """Sheets to clip each raster with: same code as in its name, boxes touching.  Rasters and sheets of a code meet in cells."""
    from ..functions.text import sheet_code

    r = rasters.withColumn("_code", F.replace(sheet_code(F.col("path")), F.lit("_"), F.lit("-")))
    s = sheets.select(
        F.replace(F.upper(F.trim("code")), F.lit("_"), F.lit("-")).alias("_code"), "sheet_id",
        *[F.col(c).alias(f"_{c}") for c in BOX],
    )
    box = [f"_{c}" for c in BOX]
    met = box_pairs(r.filter("_code IS NOT NULL"), s.filter("_code IS NOT NULL"), BOX, box, _usual_size(rasters, sheets), ["path"], keys=["_code"])
    return met.drop("_code", *box)
